"""6. Quality rules: an ordered list of threshold conjunctions, learned by sequential covering from labelled statistics.

Statistics are counted over every whole text. The list is fitted on a bounded sample of labelled rows (max_rows, taken
by hash of doc_id) on the driver: each rule starts empty and grows on two thirds of the sample by the threshold that
gains most information, until it covers no good row; then its last conditions are dropped where that raises its value
on the remaining third. A rule stays if it is precise enough there; what it covers is removed and the next one is
grown. The result is a list of (conditions -> reject) with "keep" as its default, which becomes one ordered Spark
conditional expression, evaluated JVM-side over the statistics.

Words are runs of anything but space and 0x09-0x0D. Null and empty texts have no words and fail the base rule (fewer
than 50 words). Repeated rows get the same verdict each. With no labels, or none of a class, the list is empty and the
base rule decides alone. A row whose doc_id is null or unlabelled takes no part in fitting. Labels that contradict each
other for one doc_id count as rejected. An empty table gives no rows. Other columns are passed on or ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofia.llm.common import append_columns, table, with_plain_names

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_upper", "n_marks")
STATS = ", ".join(f"{c} long" for c in COUNTS + MORE)
#: What rules test: shares of the counts, so that length alone decides nothing.
FEATURES: dict[str, tuple[str, str]] = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "distinct_words": ("n_distinct", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
}
MIN_WORDS, MAX_REPEAT = 50, 50


def statistics(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # of bytes: at space and 0x09 to 0x0D only
    n = len(words)
    blanks = sum(map(text.count, "\x20\t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = text.split("\n")
    repeated_lines = 0
    if len(set(lines)) < len(lines):
        seen: set[str] = set()
        for line in lines:
            if line in seen:
                repeated_lines += bool(line.strip("\x20\t\x0b\x0c\r"))
            else:
                seen.add(line)
    known: dict[bytes, int] = {}
    ids = np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, n)
    repeat = 0
    if n > 3:
        v = len(known)
        pairs = ids[:-1] * v + ids[1:]
        if v > 2_000_000:
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        codes = pairs[:-1] * v + ids[2:]
        order = np.argsort(codes, kind="stable")
        same = codes[order][1:] == codes[order][:-1]
        if same.any():
            often = np.zeros(n - 2, bool)
            often[order[1:][same]] = True
            often[order[:-1][same]] = True
            cover = np.zeros(n, bool)
            cover[:-2] |= often
            cover[1:-1] |= often
            cover[2:] |= often
            repeat = int(cover.sum())
    letters = np.frombuffer(raw, np.uint8)
    upper = int(np.count_nonzero((letters >= 65) & (letters <= 90)))
    return n, len(text) - blanks, symbols, repeated_lines, repeat, len(lines), len(known), upper, raw.count(b"!") + raw.count(b"?")


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    def start():
        return lambda texts: [list(c) for c in zip(*map(statistics, texts))]

    return append_columns(docs, "text", keep, start, STATS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value <= threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self, feature: Callable[[str], Column]) -> Column:
        c = feature(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray]) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while (~bad & inside).any() and len(rule) < 6:
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        best, gain = None, 1e-9
        for f, values in cuts.items():
            v = x[f][inside]
            is_bad = bad[inside]
            for above in (True, False):
                hit = v[None] >= values[:, None] if above else v[None] <= values[:, None]
                p, n = (hit & is_bad).sum(1), (hit & ~is_bad).sum(1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(g))
                if g[k] > gain:
                    best, gain = Condition(f, above, float(values[k])), g[k]
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The beginning of rule of the highest value on held-out rows, its precision there and the bad rows it covers."""
    def worth(r: Rule) -> tuple[float, int, int]:
        hit = _covers(r, x, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return ((p - n) / (p + n) if p + n else -1.0), p, n

    k = max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k])[0], worth(rule[:k])[1], -k))
    _, p, n = worth(rule[:k])
    return rule[:k], p / (p + n) if p + n else 0.0, p


def learn(stats: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 32, precision: float = 0.9, n_cuts: int = 48) -> list[Rule]:
    """Rules that reject, in order. stats: FEATURES by name; deterministic in the order of the rows."""
    rules: list[Rule] = []
    x, bad = dict(stats), bad.astype(bool)
    while bad.any() and len(rules) < max_rules:
        held = np.arange(len(bad)) % 3 == 2
        grow, prune = {f: v[~held] for f, v in x.items()}, {f: v[held] for f, v in x.items()}
        cuts = {}
        for f, v in grow.items():
            q = np.unique(np.concatenate([np.quantile(v[s], np.linspace(0, 1, n_cuts)) for s in (bad[~held], ~bad[~held]) if s.any()]))
            cuts[f] = np.unique(np.concatenate([q, (q[1:] + q[:-1]) / 2]))
        rule = _grow(grow, bad[~held], cuts)
        if not rule:
            break
        rule, exact, p = _prune(rule, prune, bad[held])
        if p == 0 or exact < precision:
            break
        rules.append(rule)
        left = ~_covers(rule, x, len(bad))
        x, bad = {f: v[left] for f, v in x.items()}, bad[left]
    return rules


def features(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f: stats[a] / np.maximum(stats[b], 1) for f, (a, b) in FEATURES.items()}


def _feature_column(name: str) -> Column:
    a, b = FEATURES[name]
    return F.col(a).cast("double") / F.greatest(F.col(b), F.lit(1)).cast("double")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def rule_fired(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 for none: one ordered conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        cond = None
        for c in rule:
            one = c.column(_feature_column)
            cond = one if cond is None else cond & one
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> list[Rule]:
    """From at most max_rows labelled documents, those of the smallest hash of doc_id; quality 0 is what rules reject."""
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows small rows
    rows = with_statistics(picked, ["doc_id", "_quality"]).orderBy(F.xxhash64("doc_id"), "doc_id", "_quality", *COUNTS).limit(max_rows).toPandas()
    if rows.empty:
        return []
    stats = {c: rows[c].to_numpy(np.float64) for c in COUNTS + MORE}
    return learn(features(stats), rows["_quality"].to_numpy() == 0)


def judge(docs: DataFrame, rules: list[Rule], keep: list[str]) -> DataFrame:
    """keep's columns, the statistics, base_failed, rule (that rejected; 0: none) and kept."""
    judged = with_statistics(docs, keep).withColumn("base_failed", base_failed()).withColumn("rule", rule_fired(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules, ["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs, all its columns, without the rejected rows. Null texts are rejected, as they have no words."""
    return with_plain_names(docs, lambda d: judge(d, rules, d.columns).filter("kept").select(*d.columns))
