"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read back memory-mapped.

Documents are range-partitioned and sorted by id (rows of one id, or without, by a hash of the text, so that they
spread, too). Each task encodes its documents one Arrow batch at a
time and appends to two flat files of its part: `.bin` (token ids, uint16 where the vocabulary fits,
else uint32, little-endian) and `.idx` (int64 document id and uint64 end offset inside the part, 16
bytes a document). A part's base, the ids of all parts before it, comes from a prefix sum over the
parts' totals; base + offset is the global position, so no file is rewritten and parts stay
independent. The manifest (one row a part) is what names the valid files: a task that ran twice leaves
files that no manifest names.

Defined results: null and empty texts give only the end id; a null document id sorts first; repeated
ids are kept, ordered by that hash; the names of added tokens in a text are those tokens, as the library's plain call
has it; an empty table gives no parts. Long texts are encoded whole.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, read

#: Pieces of the current generation whose ids a worker keeps; those of the generation before stay at hand as well.
KEPT_PIECES = 200_000
#: Longest piece that is kept.
LONGEST_PIECE = 100
#: Repeated texts whose ids a worker keeps, and their longest.
KEPT_TEXTS, LONGEST_KEPT = 500, 20_000
INDEX = np.dtype([("doc_id", "<i8"), ("end", "<u8")])
#: Stands for a null document id in the index file.
NULL_ID = -(2**63)


# The letters, digits and white space of U+0000 to U+00FF, and the standard byte-level pattern over them.
_L, _N, _S = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be", "\t-\r \u0085\u00a0"
_PIECES = re.compile(f" ?[{_L}]++| ?[{_N}]++|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]++|[{_S}]+(?![^{_S}])|[{_S}]+").findall


class Encoder:
    """encode(texts) gives the ids of the tokenizers library for each text, little-endian, `width` bytes each.

    Texts that hold the name of an added token go to the library whole.
    For the common byte-level scheme (no normaliser, the standard pattern, no prefix space) texts are cut into
    pieces where pre-tokens end, and the ids of each distinct piece are kept. A text up to U+00FF is cut into its
    pre-tokens; any other only before a space that a non-space character follows, which always begins a pre-token,
    or not at all where its white space is looser. The library encodes new pieces, many in one call: those that
    begin with a space in a row, told apart by the space's mark, which only their first tokens begin with. Words
    of ASCII letters are their own byte-level form, so they need no pattern. Any other tokenizer gets whole texts.

    Kept ids are in two generations: a full one becomes the old one, and what is met again moves on.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tok, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.chunked = self.tok.normalizer is None and re.fullmatch(r"ByteLevel\(add_prefix_space=False, .*use_regex=True\)", str(self.tok.pre_tokenizer)) is not None
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.added = re.compile("|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()) or "(?!)").search
        for t in (self.tok, self.plain):
            if self.chunked:
                t.model._resize_cache(0)  # pieces are kept here; the model sees each once
        vocabulary = self.tok.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 65536 else 4
        self.kind = f"<u{self.width}"
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.texts: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _row(self, pieces: list[str], tok, mark: str, between: str) -> Iterator[tuple[str, bytes]]:
        """Pieces that begin with a space and their ids, encoded in rows of `mark` and what follows the space."""
        for lo in range(0, len(pieces), 4000):
            part = pieces[lo : lo + 4000]
            got = tok.encode_batch_fast([mark + between.join([p[1:] for p in part[k : k + 100]]) for k in range(0, len(part), 100)], add_special_tokens=False)
            ids = np.array([i for e in got for i in e.ids], self.kind)
            cuts = (np.flatnonzero(self.spaced[ids]) * self.width).tolist()
            if len(cuts) != len(part):
                raise ValueError("pieces and tokens disagree")
            flat = ids.tobytes()
            yield from zip(part, [flat[a:b] for a, b in zip(cuts, [*cuts[1:], len(flat)], strict=True)], strict=True)

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces that the memo lacks; it keeps those of pieces that are not too long."""
        out = dict(zip(pieces, map(self.old.get, pieces), strict=True))
        pieces = {p for p, ids in out.items() if ids is None}
        plain = [p for p in pieces if p[0] == " " and p[1:].isalpha() and p.isascii()]
        other = pieces.difference(plain)
        row = [p for p in other if p[0] == " " and len(p) > 1 and not p[1].isspace() and " " not in p[1:]]
        alone = list(other.difference(row))
        out.update(self._row(plain, self.plain, "\u0120", " \u0120"))
        out.update(self._row(row, self.tok, " ", " "))
        out.update(zip(alone, self._each(alone), strict=True))
        self.memo.update(out)
        for p in pieces:
            if len(p) > LONGEST_PIECE:
                del self.memo[p]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.chunked:
            return self._each(texts)
        if marked := {i for i, t in enumerate(texts) if self.added(t)}:
            whole = iter(self._each([texts[i] for i in sorted(marked)]))
            rest = iter(self.encode([t for i, t in enumerate(texts) if i not in marked]))
            return [next(whole if i in marked else rest) for i in range(len(texts))]
        known = self.texts
        if len(known) > KEPT_TEXTS:
            known.clear()
        if any(t in known for t in texts) or len(set(texts)) < len(texts):  # copies are encoded once
            once = [t for t in dict.fromkeys(texts) if t not in known]
            fresh = dict(zip(once, self._encode(once), strict=True))
            out = [fresh[t] if t in fresh else known[t] for t in texts]
            known.update((t, fresh[t]) for t, n in Counter(texts).items() if n > 1 and t in fresh and len(t) <= LONGEST_KEPT)
            return out
        return self._encode(texts)

    def _pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            first, *chunks = text.split(" ")
            if any(not c or c[0].isspace() for c in chunks):
                return [text]
            return [*filter(None, [first]), *[" " + c for c in chunks]]
        return _PIECES(text)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > KEPT_PIECES:
            self.memo, self.old = {}, self.memo
        split, every = [self._pieces(t) for t in texts], set()
        for x in split:
            every.update(x)
        near = dict(zip(every, map(self.memo.get, every), strict=True))  # small enough for the processor's caches
        near.update(self._learn([p for p, ids in near.items() if ids is None]))
        return [b"".join(map(near.__getitem__, x)) for x in split]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _local(uri: str) -> str | None:
    u = urlparse(uri)
    return u.path if u.scheme in ("", "file") else None


def _create(uri: str):
    """A stream that writes a new file; other stores than file: go through Arrow's file systems."""
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")  # noqa: SIM115
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


class _Array:
    """A file as an array that is read by slices: memory-mapped where it is local or on a mount, else in ranges."""

    def __init__(self, uri: str, dtype):
        self.dtype, self.array = np.dtype(dtype), None
        if path := _local(uri):
            size = os.path.getsize(path)
            self.array = np.memmap(path, dtype, "r") if size else np.zeros(0, dtype)
        else:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(uri)
            self.file = store.open_input_file(path)
            size = self.file.size()
        self.length = size // self.dtype.itemsize

    def __len__(self) -> int:
        return self.length

    def part(self, a: int, b: int) -> np.ndarray:
        if self.array is not None:
            return self.array[a:b]
        return np.frombuffer(self.file.read_at((b - a) * self.dtype.itemsize, a * self.dtype.itemsize), self.dtype)


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int = 0, batch_texts: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs and returns the manifest: part, path, width, n_docs, n_tokens, base."""
    spark = docs.sparkSession
    encoder_path = tokenizer_path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(encoder_path)
        path, at, n_docs, data, index = f"{out_dir}/part-{part:06d}-{uuid.uuid4().hex}", 0, 0, None, None
        end, width = np.array([end_id], encoder.kind).tobytes(), encoder.width
        for batch in batches:
            if not batch.num_rows:
                continue
            if data is None:
                data, index = _create(f"{path}.bin"), _create(f"{path}.idx")
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(ids), batch_texts):
                got = encoder.encode([t or "" for t in texts.slice(lo, batch_texts).to_pylist()])
                rows = np.zeros(len(got), INDEX)
                rows["doc_id"] = [NULL_ID if i is None else i for i in ids[lo : lo + batch_texts]]
                rows["end"] = at + np.cumsum([len(x) // width + 1 for x in got])
                at, n_docs = int(rows["end"][-1]), n_docs + len(got)
                data.write(end.join([*got, b""]))
                index.write(rows.tobytes())
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "width": [encoder.width], "n_docs": [n_docs], "n_tokens": [at]}, schema=_PART)

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    with arrow_rows(spark, 1000):
        written = ordered.mapInArrow(run, "part int, path string, width int, n_docs long, n_tokens long").collect()  # a row for each partition
    rows, base = [], 0
    for r in sorted(written):
        rows.append((*r, base))
        base += r.n_tokens
    return spark.createDataFrame(rows, "part int, path string, width int, n_docs long, n_tokens long, base long")


_PART = pa.schema([("part", pa.int32()), ("path", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
_DOC = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _crc(ids: _Array, a: int, b: int, step: int = 1 << 20) -> int:
    """The checksum of ids a to b as 32-bit integers, a million at a time."""
    out = 0
    for lo in range(a, b, step):
        out = zlib.crc32(ids.part(lo, min(lo + step, b)).astype("<u4").tobytes(), out)
    return out


def read_token_files(manifest: DataFrame, batch_docs: int = 4096) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone. A part is a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, index, last = _Array(f"{r['path']}.bin", f"<u{r['width']}"), _Array(f"{r['path']}.idx", INDEX), 0
                for lo in range(0, len(index), batch_docs):
                    rows = index.part(lo, min(lo + batch_docs, len(index)))
                    ends = rows["end"].astype(np.int64)
                    starts = np.concatenate([[last], ends[:-1]]).astype(np.int64)
                    last = int(ends[-1])
                    crc = [_crc(ids, a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": [None if i == NULL_ID else i for i in rows["doc_id"].tolist()], "start": starts + r["base"], "n_tokens": ends - starts, "ids_crc32": crc}, schema=_DOC
                    )

    parts = manifest.count()
    return manifest.repartitionByRange(max(1, parts), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Writes docs into a new folder of the session's shared one and returns what the files say of each document."""
    scratch = Scratch(docs.sparkSession)
    return read_token_files(write_token_files(docs, scratch.path("tokens"), tokenizer_path, end_id))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of documents, encoded with the 50k public byte-level tokenizer, written and read back."""
    import public_tokenizers

    return tokenise(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
