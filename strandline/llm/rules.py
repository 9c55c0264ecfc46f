"""Quality rules as a learned decision list.

Statistics of each whole text (words, characters, symbols, repeated lines and word windows, and a few more) are counted exactly, one
chunk of texts at a time.  From labelled rows, sequential covering learns when to reject a text: a rule is a conjunction of
thresholds over shares of these statistics, grown condition by condition by information gain on two thirds of the rows that no
rule covers yet, and pruned from its end on the last third; it is taken if few of the good rows meet it, and the rows it covers
leave the search.  Rules that the list can do without are struck out in the end.  The list becomes one ordered Spark conditional
expression; texts that fail the base limits are rejected before it.

Only rows of statistics reach the driver: ``SAMPLE_PER_CLASS`` labelled rows a class at most, those with the smallest hashes of the
id in the training fold (crc32(doc_id) mod 5 not 0).  Everything else covers all rows and whole texts.

Defined cases: a null or empty text has no words, so it fails the base limits; without labels of both classes the list is empty and
the base limits decide; a repeated id is one labelled row (the text with the smallest hash); a null doc_id is judged and never
learned from; ties between conditions go to the first statistic, then to the lower threshold; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, small_batches
from .exact_words import BLANK, byte_set, interned, numbered, per_text, runs
from .labelled import labelled_ids

SAMPLE_PER_CLASS = 20_000
#: Base limits: least words, and the largest percentage of words in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3
#: A rule has this many conditions at most, and meets this share of rejected rows among those it covers at least.
CONDITIONS = 4
PRECISION = 0.95
#: A rule covers this many rejected rows at least.
COVER = 5
#: Thresholds tried for each statistic: quantiles of the rows at hand.
THRESHOLDS = 48
ROWS = 1 << 13

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_stops", "n_commas", "n_calls", "n_runs"]
#: Shares that rules may look at: name, count, count it is divided by.
SHARES = [
    ("mean_word", "word_chars", "n_words"),
    ("symbols", "n_symbols", "n_words"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeated", "n_repeat_words", "n_words"),
    ("distinct", "n_distinct", "n_words"),
    ("upper", "n_upper", "word_chars"),
    ("digits", "n_digits", "word_chars"),
    ("stops", "n_stops", "n_words"),
    ("commas", "n_commas", "n_words"),
    ("calls", "n_calls", "n_words"),
    ("adjacent", "n_runs", "n_words"),
    ("line_words", "n_words", "n_lines"),
]
_SYMBOLS, _STOPS, _COMMAS, _CALLS = byte_set(b"#*$%&|<>"), byte_set(b"."), byte_set(b",;:"), byte_set(b"!?")
_UPPER, _DIGITS = byte_set(bytes(range(65, 91))), byte_set(bytes(range(48, 58)))


def counts_of(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS of each text of a chunk."""
    n = len(offs) - 1
    starts, ends, doc = runs(~BLANK[data], offs)
    word, distinct = interned(data, starts, ends)
    size = len(distinct) + 1
    out = {"n_words": np.bincount(doc, minlength=n)}
    out["word_chars"] = per_text(~BLANK[data] & ((data & 0xC0) != 0x80), offs)
    out["n_symbols"] = per_text(_SYMBOLS[data], offs)
    # lines with a word, whole
    first, last, owner = runs(data != 10, offs)
    with_word = np.zeros(len(first), bool)
    with_word[np.searchsorted(first, starts, "right") - 1] = True
    first, last, owner = first[with_word], last[with_word], owner[with_word]
    line, _ = interned(data, first, last)
    _, lines = numbered(line * n + owner)
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(lines % n, minlength=n)
    _, pairs = numbered(word * n + doc)
    out["n_distinct"] = np.bincount(pairs % n, minlength=n)
    # windows of three words inside a text; a word of one that is found twice or more there is repeated
    repeated = np.zeros(len(word), bool)
    if len(word) >= WINDOW:
        at = np.flatnonzero(doc[WINDOW - 1 :] == doc[: len(doc) - WINDOW + 1])
        code = word[at]
        for k in range(1, WINDOW):
            code, _ = numbered(code * size + word[at + k])
        code, _ = numbered(code * n + doc[at])
        often = at[np.bincount(code)[code] > 1] if len(code) else at
        for k in range(WINDOW):
            repeated[often + k] = True
    out["n_repeat_words"] = np.bincount(doc[repeated], minlength=n)
    again = np.flatnonzero((word[1:] == word[:-1]) & (doc[1:] == doc[:-1])) if len(word) else np.zeros(0, np.int64)
    out["n_runs"] = np.bincount(doc[again], minlength=n)
    for name, table in (("n_upper", _UPPER), ("n_digits", _DIGITS), ("n_stops", _STOPS), ("n_commas", _COMMAS), ("n_calls", _CALLS)):
        out[name] = per_text(table[data], offs)
    return out


def statistics(docs: DataFrame, columns: list[str], prefix: str = "") -> DataFrame:
    """columns of docs, and COUNTS (long, names with the prefix) of each whole text."""
    names = [prefix + c for c in COUNTS]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lo, hi, data, offs in byte_chunks(texts, rows=ROWS):
                counts = counts_of(data, offs)
                kept = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]], [*columns, *names])

    types = dict(docs.dtypes)
    shape = ", ".join([*[f"`{c}` {types[c]}" for c in columns], *[f"`{c}` long" for c in names]])
    return small_batches(docs).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "text"])]).mapInArrow(run, shape)


@dataclass(frozen=True)
class Condition:
    """share <= threshold, or > if above."""

    share: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.share} {'>' if self.above else '<='} {self.threshold:.6g}"

    def column(self, prefix: str = "") -> Column:
        _, over, under = next(s for s in SHARES if s[0] == self.share)
        value = F.col(prefix + over) / F.greatest(F.col(prefix + under), F.lit(1))
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.share]
        return v > self.threshold if self.above else v <= self.threshold


Rule = tuple[Condition, ...]


def shares_of(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: counts[over] / np.maximum(counts[under], 1) for name, over, under in SHARES}


def covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(values) for c in rule), np.ones(n, bool))


def _thresholds(v: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring distinct values, at the quantiles of the rows."""
    distinct = np.unique(v)
    if len(distinct) < 2:
        return np.zeros(0)
    if len(distinct) > THRESHOLDS:
        distinct = np.unique(np.quantile(v, np.linspace(0, 1, THRESHOLDS), method="nearest"))
    return (distinct[1:] + distinct[:-1]) / 2


def grown(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions added as long as the rule covers good rows and one gains (FOIL's information gain)."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS:
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p or not n:
            break
        now, best, chosen = np.log2(p / (p + n)), 1e-9, None
        for name, _, _ in SHARES:
            v, y = values[name][inside], bad[inside]
            cuts = _thresholds(v)
            if not len(cuts):
                continue
            below = np.searchsorted(cuts, v, "left")  # cuts from here on hold the row
            ps = np.cumsum(np.bincount(below[y], minlength=len(cuts) + 1))[: len(cuts)]
            ns = np.cumsum(np.bincount(below[~y], minlength=len(cuts) + 1))[: len(cuts)]
            for above, pp, nn in ((False, ps, ns), (True, p - ps, n - ns)):
                gain = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1) / np.maximum(pp + nn, 1)) - now), 0.0)
                at = int(np.argmax(gain))
                if gain[at] > best:
                    best, chosen = float(gain[at]), Condition(name, above, float(cuts[at]))
        if chosen is None:
            break
        rule += (chosen,)
        inside &= chosen.holds(values)
    return rule


def pruned(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The rule without those of its last conditions that are of no use on rows it was not grown on: (p - n) / (p + n) is largest."""
    best, kept = -2.0, rule
    for k in range(len(rule), 0, -1):
        at = covers(rule[:k], values, len(bad))
        p, n = int(bad[at].sum()), int((~bad[at]).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth >= best:
            best, kept = worth, rule[:k]
    return kept


def learned(counts: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """The ordered rules that reject, from counts of labelled rows in a fixed order."""
    values, left, rules = shares_of(counts), np.ones(len(bad), bool), []
    third = np.arange(len(bad)) % 3 == 2
    while bad[left].sum() >= COVER and (~bad[left]).any():
        take = lambda mask: ({k: v[mask] for k, v in values.items()}, bad[mask])
        rule = grown(*take(left & ~third))
        if not rule:
            break
        rule = pruned(rule, *take(left & third))
        at = covers(rule, values, len(bad)) & left
        p, n = int(bad[at].sum()), int((~bad[at]).sum())
        if p < COVER or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~at
    for rule in list(reversed(rules)):  # a rule that the others make needless goes
        rest = [r for r in rules if r is not rule]
        if _errors(rest, values, bad) <= _errors(rules, values, bad):
            rules = rest
    return rules


def _errors(rules: list[Rule], values: dict[str, np.ndarray], bad: np.ndarray) -> int:
    met = reduce(np.logical_or, (covers(r, values, len(bad)) for r in rules), np.zeros(len(bad), bool))
    return int((met != bad).sum())


def base_failed(prefix: str = "") -> Column:
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def verdict(rules: list[Rule], prefix: str = "") -> Column:
    """The base limits, then the list, as one conditional expression: true if the text is kept."""
    out = F.when(base_failed(prefix), F.lit(False))
    for rule in rules:
        out = out.when(reduce(lambda a, b: a & b, (c.column(prefix) for c in rule)), F.lit(False))
    return out.otherwise(F.lit(True))


def describe(rules: list[Rule]) -> list[str]:
    """The list in words, first rule first."""
    return [f"reject if {' and '.join(map(str, r))}" for r in rules] + ["else keep"]


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> list[Rule]:
    """Rules from labelled texts that pass the base limits (the list only judges those)."""
    picked, _ = labelled_ids(labels, label, per_class)
    if picked is None:
        return []
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id")
    rows = rows.groupBy("doc_id", "__y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    got = statistics(rows, ["doc_id", "__y"]).where(~base_failed()).select("doc_id", "__y", *COUNTS).collect()
    got = sorted(got, key=lambda r: (hash_order(r["doc_id"]), r["doc_id"]))
    counts = {c: np.array([r[c] for r in got], np.int64) for c in COUNTS}
    return learned(counts, np.array([r["__y"] == 0 for r in got], bool))


def hash_order(doc_id: int) -> int:
    """An order of ids that has nothing to do with their size."""
    return (int(doc_id) * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64) >> 16


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts of the contract, base_failed and kept of every document."""
    rules = learn(docs, labels)
    out = statistics(docs, ["doc_id"])
    return out.select("doc_id", *COUNTS[:5], base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep; columns unchanged."""
    rules = learn(docs, labels)
    return statistics(docs, docs.columns, "__count_").where(verdict(rules, "__count_")).select(*[F.col(f"`{c}`") for c in docs.columns])
