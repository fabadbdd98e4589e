"""License scans: ordered signature rules with a keyword prefilter and overlap suppression.

A rule is (label, kind, keywords, regular expression); license_rules holds them, written by hand per license:
titles with their optional words and versions, clauses of the license texts, addresses, identifiers and mentions.
One automaton finds all keywords in one pass over the text; a rule is tried only if one of its keywords occurs
(at the beginning of a word, but for addresses).
A title behind words that grant ("released under the ...") is a grant, however much white space or punctuation stands between them. Detections of all rules are ordered by
priority: the kind's rank (base phrases first), then longer spans, then the rule's order; a detection whose span
lies inside that of one before it is suppressed, whatever their labels. What suppresses a suppressed detection
suppresses what that one would, so one sweep over the spans by their starts, with the farthest end of each rank so
far, decides all in linear time after the sort. Base phrases are never suppressed: all their places are counted.
Identifiers are looked up in SPDX expressions only: what follows the tag on its line, however long, up to the first
word that no operator (and, or, with, a comma, slash, semicolon, bar or ampersand) joins. Each identifier there, with
or without a plus, is a detection whose span is the identifier.

Texts are lower-cased (A-Z) and matched as UTF-8 bytes read one to one as characters, so that a word is
`[0-9a-z\\x80-\\xff]+` there exactly where it is `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in the text. One pass,
no shuffle; rules are code, so nothing grows with the data.

Defined results: null or empty text has 0 words, no places, empty labels, score 0; whole texts are
scanned whatever their length; rows are independent, so ties, repeats, null ids, empty tables and further
columns make no difference.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_rules
from .common import WORD_CLASS, WORDS, count_words, map_arrow, read

SEP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
START, END = r"(?<![0-9a-z\x80-\xff])", r"(?![0-9a-z\x80-\xff])"

_ID = r"[0-9a-z][0-9a-z.:+-]*"
#: A tag and the expression after it; group 1 is the expression.
EXPRESSION = re.compile(rf"spdx-license-identifier:[ \t(]*({_ID}(?:[ \t)]*(?:(?<=[ \t)])(?:and|or|with)(?=[ \t(])|[,;/|&]+)[ \t(]*{_ID})*)")

#: Base phrases of the contract and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Kinds by rank: a kind's detections suppress those of later kinds inside them.
KINDS = {"base": (0, 1.0), "text": (1, 0.98), "spdx": (2, 0.97), "grant": (3, 0.95), "url": (4, 0.93), "title": (5, 0.9), "mention": (6, 0.6)}

#: Words that grant, right before a title.
GRANTS = (
    "licen[cs]ed under|released under|distributed under|redistributed under|available under|provided under|published under|offered under|covered by|governed by|subject to|"
    "(?:under|to|in accordance with) the (?:terms|conditions|terms and conditions) of|permitted under|pursuant to"
)


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern

    @property
    def rank(self) -> int:
        return KINDS[self.kind][0]


def _spread(pattern: str) -> str:
    """A pattern over words: blanks are separators, @ is a version."""

    def version(m: re.Match) -> str:
        minor = rf"(?:\.{m[2]})?" if m[2] == "0" else rf"\.{m[2]}"
        return rf"(?:{SEP}(?:version|ver|v|release))?(?:{SEP})?v?{m[1]}{minor}"

    pattern = pattern.replace(" ?", "\0").replace(" ", SEP).replace("\0", f"(?:{SEP})?")
    return re.sub(r"@([0-9]+)\.([0-9]+)", version, pattern)


def _worded(pattern: str) -> re.Pattern:
    return re.compile(f"{START}(?:{_spread(pattern)}){END}", re.S)


def _address(pattern: str) -> re.Pattern:
    """An address between places that cannot belong to it."""
    pattern = re.sub(r"(?<!\\)(?<!\])\.", r"\\.", pattern)
    return re.compile(rf"(?<![0-9a-z_.-])(?:(?:https?://)?www\.|https?://)?(?:{pattern})(?:\.(?:html?|php|txt|md|en|de))*/?(?![0-9a-z_-]|\.[0-9a-z])")


def _table(text: str) -> list[list[str]]:
    return [[x.strip() for x in line.split(" | ")] for line in text.strip().splitlines()]


@cache
def build_rules() -> tuple[Rule, ...]:
    """All rules in order. A title's rule is followed by that of its grants, which has the same pattern."""
    rules = [Rule(label, "base", (phrase.split()[0],), _worded(phrase)) for phrase, label in BASE]
    rules += [Rule(label, "text", tuple(k.split("|")), _worded(p)) for label, p, k in _table(license_rules.CLAUSES)]
    rules += [Rule(label, "spdx", ("spdx",), re.compile(re.escape(x.strip()))) for label, ids in _table(license_rules.IDENTIFIERS) for x in ids.split(",")]
    for label, p, k in _table(license_rules.TITLES):
        pattern = _worded(p)
        rules += [Rule(label, "title", tuple(k.split("|")), pattern), Rule(label, "grant", (), pattern)]
    rules += [Rule(label, "url", tuple(k.split("|")), _address(p)) for label, p, k in _table(license_rules.ADDRESSES)]
    rules += [Rule(label, "mention", tuple(k.split("|")), _worded(p)) for label, p, k in _table(license_rules.MENTIONS)]
    return tuple(rules)


#: Granting words at the beginning of a word, with the separators after them; and a word that may stand before the title.
_GRANT = re.compile(rf"{START}(?=((?:{_spread(GRANTS)}){SEP}))")
_FILLER = re.compile(rf"(?:the|a|an|gnu|same|terms|of){SEP}")
FILLERS = 4


def grant_ends(s: str) -> dict[int, int]:
    """{where a title would have to begin to be granted: where the granting words begin}, of a lower-cased text."""
    out: dict[int, int] = {}
    for m in _GRANT.finditer(s):
        at = m.end(1)
        out.setdefault(at, m.start())
        for _ in range(FILLERS):
            if not (f := _FILLER.match(s, at)):
                break
            at = f.end()
            out.setdefault(at, m.start())
    return out


class Scanner:
    """scan(text bytes) gives the kept detections as (start, end, rule index), by start."""

    def __init__(self, rules: tuple[Rule, ...] | None = None):
        self.rules = rules or build_rules()
        self.ranks = [r.rank for r in self.rules]
        self.identifiers = {r.pattern.pattern.replace("\\", ""): i for i, r in enumerate(self.rules) if r.kind == "spdx"}
        by_keyword: dict[str, tuple[list[int], list[int]]] = {}
        for i, r in enumerate(self.rules):
            for k in r.keywords if r.kind != "spdx" else ():
                by_keyword.setdefault(k, ([], []))[r.kind == "url"].append(i)
        self.automaton = ahocorasick.Automaton()
        for k, (worded, anywhere) in by_keyword.items():
            self.automaton.add_word(k, (len(k), worded, anywhere))
        self.automaton.make_automaton()

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        return suppressed(self.detections(data.lower().decode("latin-1")), self.ranks)

    def tried(self, s: str) -> list[int]:
        """The rules of which a keyword occurs, at the beginning of a word unless they are addresses."""
        out = set()
        for last, (n, worded, anywhere) in self.automaton.iter(s):
            if anywhere:
                out.update(anywhere)
            if worded and (last < n or not _WORD_BYTE[ord(s[last - n])]):
                out.update(worded)
        return sorted(out)

    def detections(self, s: str) -> list[tuple[int, int, int]]:
        """All of a lower-cased text, in any order."""
        found, grants = [], None
        for i in self.tried(s):
            spans = [m.span() for m in self.rules[i].pattern.finditer(s)]
            if self.rules[i].kind == "title":
                if spans and grants is None:
                    grants = grant_ends(s)
                found += [(grants[a], b, i + 1) if a in grants else (a, b, i) for a, b in spans]
            else:
                found += [(a, b, i) for a, b in spans]
        if "spdx-license-identifier:" in s:
            for e in EXPRESSION.finditer(s):
                for m in _NAME.finditer(s, *e.span(1)):
                    name = m[0].rstrip(".:")
                    if (i := self.identifiers.get(name.rstrip("+"))) is not None:
                        found.append((m.start(), m.start() + len(name), i))
        return found


_NAME = re.compile(_ID)
_WORD_BYTE = bytes(WORD_CLASS[WORDS[c]] == 120 for c in range(256))


def suppressed(found: list[tuple[int, int, int]], ranks: list[int]) -> list[tuple[int, int, int]]:
    """The detections (start, end, rule) that none before them in order holds, by start; rank 0 always stays."""
    kept, farthest = [], [-1] * (max(ranks, default=0) + 1)
    for a, b, i in sorted(found, key=lambda f: (f[0], -f[1], ranks[f[2]], f[2])):
        rank = ranks[i]
        if rank == 0 or max(farthest[: rank + 1]) < b:
            kept.append((a, b, i))
        if farthest[rank] < b:
            farthest[rank] = b
    return sorted(kept)


def license_detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: n_words, detections (label, kind, confidence, start and end byte offset in the UTF-8 text, first word) by start, score.

    The score joins the detections' confidences as independent: 1 - product of (1 - confidence) over labels.
    """
    schema = f"{id_col} long, n_words long, detections array<struct<label: string, kind: string, confidence: double, start: long, end: long, word: long>>, score double"
    item = pa.struct([("label", pa.string()), ("kind", pa.string()), ("confidence", pa.float64()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64())])

    def make():
        scanner = Scanner()
        kinds = [(r.label, r.kind, KINDS[r.kind][1]) for r in scanner.rules]

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, rows, scores = [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                data = data or b""
                counts.append(count_words(data, _CLASSES))
                found, best, word, at = [], {}, 0, 0
                for a, b, i in scanner.scan(data):
                    word, at = word + _starts(data, at, a), max(at, a)
                    label, kind, confidence = kinds[i]
                    best[label] = max(best.get(label, 0.0), confidence)
                    found.append({"label": label, "kind": kind, "confidence": confidence, "start": a, "end": b, "word": word})
                miss = 1.0
                for c in best.values():
                    miss *= 1.0 - c
                rows.append(found)
                scores.append(1.0 - miss)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(rows, pa.list_(item)), pa.array(scores)], names=[id_col, "n_words", "detections", "score"])

        return run

    return map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_col), make, schema)


#: x for bytes in words, space for the others, straight from the text.
_CLASSES = bytes(WORD_CLASS[WORDS[c]] for c in range(256))


def _starts(data: bytes, a: int, b: int) -> int:
    """Words that start in [a, b) of data."""
    marks = data[max(a - 1, 0) : b].translate(_CLASSES)
    return marks.count(b" x") + (a == 0 and marks.startswith(b"x"))


def license_scan(docs: DataFrame) -> DataFrame:
    """The digest columns of license_detections: base places of all base phrases, labels and score."""
    d = license_detections(docs)
    base = F.filter("detections", lambda x: x.kind == "base")
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x.label))), ",")
    return d.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x.word)).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x.word)).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        "score",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of every whole text of documents."""
    return license_scan(read(spark, sf_dir, "documents"))
