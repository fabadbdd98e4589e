"""Token counts: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary's matches in a word; dynamic programming carries,
for each position, the best score and the number of pieces on the best path, with the tie rule of the
tokenizers library's Unigram model: ends in ascending order, starts in ascending order, and a later
candidate wins only if it is strictly better, so of equal paths the one whose last piece starts first
stays. A character that no single-character piece covers may be passed as unknown at 10 less than the
lowest score; a run of unknowns is one string, which counts 1 if it is a piece, else its UTF-8 bytes
where the vocabulary has byte pieces, else 1.

Spaces become U+2581, one is put in front, and each such mark begins a word; words are scored alone, so
the counts of equal words are kept in a bounded map. Documents are independent: one pass, no shuffle.

Defined results: null or empty text has 0 tokens; a text of one space has 1; very long words and texts
are counted whole in time linear in their length, and a word's tables hold its last `WINDOW` characters; rows are
independent, so ties, repeats, null ids, empty tables and further columns make no difference; ids of any type are kept.
"""

from __future__ import annotations

from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import map_arrow, read

MARK = "▁"
#: Words whose counts a worker keeps.
KEPT_WORDS = 400_000
#: Characters of a word whose scores are at hand: the longest piece, at least.
WINDOW = 1 << 16
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a public piece file, in the order of ids."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(s.id_to_piece(i), s.get_score(i)) for i in range(s.get_piece_size())]


class Counter:
    """Counts tokens of words under pieces with scores; unk_id is the unknown piece."""

    def __init__(self, pieces: list[tuple[str, float]], unk_id: int = 0):
        self.pieces = {p for p, _ in pieces}
        self.unk = pieces[unk_id][0]
        self.unk_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.byte_pieces = all(f"<0x{b:02X}>" in self.pieces for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            if p:
                self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.memo: dict[str, int] = {}
        self.longest = max((len(p) for p, _ in pieces), default=1)

    def _run(self, word: str, start: int, end: int) -> int:
        text = word[start:end]
        return 1 if text in self.pieces or not self.byte_pieces else len(text.encode())

    def word(self, word: str) -> int:
        """Pieces on the best path through one word."""
        n, reach = len(word), self.longest
        window = min(n, max(WINDOW, 4 * reach)) + 1
        base, size = 0, window  # places base.. of the word are in the lists
        score, count, run = [0.0] * size, [-1] * size, [-1] * size
        count[0] = 0  # count: pieces before the open run of unknowns; run: where it began, or -1
        single = bytearray(size)
        unk_score, unknown_piece, at = self.unk_score, len(self.unk), 0

        for last, (length, value) in chain(self.automaton.iter(word), ((n, (0, 0.0)),)):
            while at < last:  # ends before this one are final but for the unknown character
                at += 1
                j = at - base
                if j >= size - 1 and j > reach:  # what no piece reaches is dropped
                    drop, j = j - reach, reach
                    base += drop
                    for x, empty in ((score, 0.0), (count, -1), (run, -1), (single, 0)):
                        del x[:drop]
                        x.extend([empty] * drop)
                if not single[j]:
                    s = score[j - 1] + unk_score
                    if count[j] < 0 or s > score[j]:
                        score[j], count[j], run[j] = s, count[j - 1], run[j - 1] if run[j - 1] >= 0 else at - 1
            if length:
                j = last + 1 - base
                i = j - length
                if length == 1:
                    single[j] = 1
                s = score[i] + value
                if count[j] < 0 or s > score[j]:
                    score[j] = s
                    if unknown_piece == length and word[base + i : base + j] == self.unk:  # the unknown piece's own name
                        count[j], run[j] = count[i], run[i] if run[i] >= 0 else base + i
                    else:
                        count[j] = 1 + (count[i] if run[i] < 0 else count[i] + self._run(word, run[i], base + i))
                        run[j] = -1
        j = n - base
        return count[j] if run[j] < 0 else count[j] + self._run(word, run[j], n)

    def text(self, text: str) -> int:
        if not text:
            return 0
        t = text.replace(" ", MARK)
        words = (t[1:] if t[0] == MARK else t).split(MARK)
        memo, total = self.memo, 0
        for w in words:
            n = memo.get(w)
            if n is None:
                n = self.word(MARK + w)
                if len(w) < 64:
                    if len(memo) >= KEPT_WORDS:
                        memo.clear()
                    memo[w] = n
            total += n
        return total


_COUNTERS: dict[tuple[str, int], Counter] = {}


def _counter(path: str, unk_id: int) -> Counter:
    if (path, unk_id) not in _COUNTERS:
        _COUNTERS[path, unk_id] = Counter(vocabulary(path), unk_id)
    return _COUNTERS[path, unk_id]


def token_counts(docs: DataFrame, tokenizer_path: str, unk_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_chars) for every row of docs. tokenizer_path is a file that every executor has."""

    def make():
        counter = _counter(tokenizer_path, unk_id)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([counter.text(t or "") for t in texts], pa.int64()), pa.array([len(t or "") for t in texts], pa.int64())],
                names=[id_col, "n_tokens", "n_chars"],
            )

        return run

    rows = docs.select(F.col(id_col).alias(id_col), text_col)
    return map_arrow(rows, make, StructType([rows.schema[0]]).add("n_tokens", LongType()).add("n_chars", LongType()))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of documents under the pieces and scores of the 32k public piece file."""
    import public_tokenizers

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
