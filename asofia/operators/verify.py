"""Deterministic verification of tags against their evidence, merging, metrics, golden scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_type

from asofia.functions.text import citation_key
from asofia.operators.documents import share_of
from asofia.operators.themes import Theme, resolve_sectors
from asofia.session import spread

LEAST_QUOTE, FUZZY, GAP = 8, 92.0, 0.2
ROLES = ("peripheral", "adjacent", "core")


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def _combed(pairs: list[tuple[str, str]]) -> list[float]:
    """partial_ratio of pairs, the shorter first: the longest common subsequences of a with every stretch of b from one
    combing of strands, a diagonal of cells of all pairs at a time. Rows that a shorter text lacks change nothing."""
    n, m = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    rows, cols = int(n.max()), int(m.max())
    x, y = np.zeros((len(pairs), rows), np.uint32), np.full((len(pairs), cols), 0xFFFFFFFF, np.uint32)
    for k, (a, b) in enumerate(pairs):
        x[k, : len(a)], y[k, : len(b)] = _codes(a)[::-1], _codes(b)
    own = np.arange(rows) < n[:, None]
    across = np.tile(np.arange(rows, dtype=np.int32), (len(pairs), 1))
    down = (n[:, None] + np.arange(cols)).astype(np.int32)
    for d in range(rows + cols - 1):
        low, high = max(0, rows - 1 - d), min(rows, rows - 1 - d + cols)
        j = low + d - (rows - 1)
        h, v = across[:, low:high], down[:, j : j + high - low]
        turn = ((x[:, low:high] == y[:, j : j + high - low]) | (h > v)) & own[:, low:high]
        across[:, low:high], down[:, j : j + high - low] = np.where(turn, v, h), np.where(turn, h, v)
    return [_best(int(a), int(b), down[k, :b]) for k, (a, b) in enumerate(zip(n, m))]


def _best(n: int, m: int, down: np.ndarray) -> float:
    end, start = np.arange(m), down - n  # the strand that leaves below at end came in above at start, from the left if negative
    size = np.concatenate([np.arange(1, n), np.full(m - n + 1, n), np.arange(n - 1, 0, -1)])  # of the stretches that begin at 1 - n, 2 - n ...
    inside = (start >= 0) & (end < start + n)
    change = np.zeros(n + m + 1, np.int64)  # a strand that begins and ends within a stretch is a character of it without a partner
    np.add.at(change, end[inside], 1)
    np.add.at(change, start[inside] + n, -1)
    return float((200.0 * (size - np.cumsum(change)[: n + m - 1]) / (n + size)).max())


#: Pairs combed together; they are alike in length, so little is padded.
TOGETHER = 48


def partial_ratios(pairs: list[tuple[str, str]]) -> list[float]:
    """100 * the best normalised indel similarity of the shorter text of each pair with a stretch of the longer, as long or cut off by its ends."""
    ordered = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    out = [100.0 if a and a in b else 0.0 for a, b in ordered]
    rest = sorted((k for k, (a, b) in enumerate(ordered) if a and not out[k]), key=lambda k: (len(ordered[k][0]) // 16, len(ordered[k][1])))
    for at in range(0, len(rest), TOGETHER):
        some = rest[at : at + TOGETHER]
        for k, value in zip(some, _combed([ordered[k] for k in some])):
            out[k] = value
    return out


def partial_ratio(a: str, b: str) -> float:
    return partial_ratios([(a, b)])[0]


GRAM = 5


def _grams(a: str) -> np.ndarray:
    x = _codes(a).astype(np.uint64)
    n = max(len(x) - GRAM + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(GRAM if n else 0):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n]
    return h


def may_reach(a: str, b: str, least: float = FUZZY) -> bool:
    """Whether partial_ratio may be least or more: False only if it can't.

    At a similarity of p the shorter text's n characters and a stretch's differ by at most 2 n (1 - p) insertions and
    deletions; each spoils at most GRAM of the shorter's grams, and what is left of them stands within that stretch.
    """
    if len(a) > len(b):
        a, b = b, a
    spoiled = GRAM * int(2 * len(a) * (1 - least / 100) + 1e-9)
    need = len(a) - GRAM + 1 - spoiled
    if need <= 0:
        return True
    met = np.concatenate([[0], np.cumsum(np.isin(_grams(b), _grams(a)))])
    wide = min(len(a) - GRAM + 1, len(met) - 1)
    return int((met[wide:] - met[: len(met) - wide]).max()) >= need


def cites(quote: str, source: str) -> bool:
    """Whether partial_ratio is FUZZY or more; the count of common grams decides where it can."""
    return quote in source or bool(quote and source) and may_reach(quote, source) and partial_ratio(quote, source) >= FUZZY


@F.arrow_udf(T.DoubleType())
def fuzzy(quote: pa.Array, source: pa.Array) -> pa.Array:
    return pa.array(partial_ratios([(q or "", s or "") for q, s in zip(quote.to_pylist(), source.to_pylist())]), pa.float64())


SOURCES = ("business", "segments", "disclosures")


@F.arrow_udf(T.StringType())
def cited_as(quote: pa.Array, claimed: pa.Array, business: pa.Array, segments: pa.Array, disclosures: pa.Array) -> pa.Array:
    """The source that holds the quote: the claimed one if it does, else the first that does."""
    out = []
    for q, c, *texts in zip(*(x.to_pylist() for x in (quote, claimed, business, segments, disclosures))):
        have = dict(zip(SOURCES, texts))
        order = [*(n for n in (c,) if n in have), *(n for n in SOURCES if n != c)]
        out.append(next((n for n in order if len(q or "") >= LEAST_QUOTE and cites(q, have[n] or "")), None))
    return pa.array(out, pa.string())


def cited_exactly(quote: Column, source: Column) -> Column:
    q = citation_key(quote)
    return (F.length(q) >= LEAST_QUOTE) & F.contains(citation_key(source), q)


def verify_citations(rows: DataFrame, quote: str, source: str) -> DataFrame:
    """cited and similarity: the exact test is native; just what fails it reaches Python."""
    marked = rows.withColumn("_exact", cited_exactly(F.col(quote), F.col(source))).withColumn("_long", F.length(citation_key(F.col(quote))) >= LEAST_QUOTE)
    sure = marked.filter("_exact OR NOT _long").withColumn("similarity", F.when(F.col("_exact"), 100.0).otherwise(0.0))
    spark = rows.sparkSession
    spread = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work: as many tasks as keep all cores busy
    rest = marked.filter("NOT _exact AND _long").repartition(spread).withColumn("similarity", fuzzy(citation_key(F.col(quote)), citation_key(F.col(source))))
    return sure.unionByName(rest).withColumn("cited", F.col("similarity") >= FUZZY).drop("_exact", "_long")


def _window_hashes(s: str) -> np.ndarray:
    """A hash of the LEAST_QUOTE characters from each place on."""
    x = _codes(s).astype(np.uint64)
    n = len(x) - LEAST_QUOTE + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(LEAST_QUOTE if n > 0 else 0):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n]
    return h


#: Bytes of quotes that a pass sends to the tasks.
PASS_BYTES = 64_000_000


def quoted_items(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(doc, item) wherever a document's text holds an item's, white space apart, of LEAST_QUOTE characters or more: every item against every whole text.

    Items are read in passes of a bounded size. In a pass each document's windows are looked up among the items' first
    LEAST_QUOTE characters at once, and only what meets is compared, so the cost follows the texts, not texts times items.
    """
    keyed = items.select(F.col(item).alias("i"), citation_key(F.col("text")).alias("q")).filter(F.length("q") >= LEAST_QUOTE)
    size = keyed.agg(F.sum(F.octet_length("q") + 16)).first()[0] or 0
    passes = max(1, -(-int(size) // pass_bytes))
    texts = docs.select(F.col(doc).alias("d"), citation_key(F.col("text")).alias("t")).filter(F.length("t") >= LEAST_QUOTE)
    schema = T.StructType([T.StructField(doc, docs.schema[doc].dataType), T.StructField(item, items.schema[item].dataType)])
    spark, out = docs.sparkSession, None
    for k in range(passes):
        found = sorted((r.q, r.i) for r in keyed.filter(F.pmod(F.xxhash64("q"), F.lit(passes)) == k).collect())  # some pass_bytes
        heads = np.array([int(_window_hashes(q[:LEAST_QUOTE])[0]) for q, _ in found], np.uint64)
        order = np.argsort(heads, kind="stable")
        sent = spark.sparkContext.broadcast((heads[order], [found[i] for i in order]))

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            heads, quotes = sent.value
            firsts = np.unique(heads)
            for b in batches:
                rows: list[tuple] = []
                for d, t in zip(b.column("d").to_pylist(), b.column("t").to_pylist()):
                    h = _window_hashes(t)
                    at = np.flatnonzero(np.isin(h, firsts))
                    held: set = set()
                    for p, lo, hi in zip(at.tolist(), np.searchsorted(heads, h[at]).tolist(), np.searchsorted(heads, h[at], "right").tolist()):
                        held.update(k for k in range(lo, hi) if k not in held and t.startswith(quotes[k][0], p))
                    rows += [(d, quotes[k][1]) for k in sorted(held)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], to_arrow_type(f.dataType)) for c, f in enumerate(schema)], names=schema.names)

        part = spread(texts).mapInArrow(look, schema)
        out = part if out is None else out.unionByName(part)
    return out


def rank_of(role: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES]), role), F.lit(0)).cast("int")


def merge_assignments(rows: DataFrame, key: str = "ticker", order: str = "pos") -> DataFrame:
    """One row a key and theme: strongest role, highest confidence, summed claims, longest quote (the first of several) with its source, segments in order, rationales joined unless one holds the next, 200 characters."""
    length = F.length(F.coalesce("evidence_quote", F.lit("")))
    first = F.struct(length.alias("n"), (-F.col(order)).alias("o"))
    grouped = rows.groupBy(key, "theme_id").agg(
        F.max(rank_of(F.col("role"))).alias("_r"), F.max(F.coalesce("confidence", F.lit(0.0))).alias("confidence"), F.sum(F.coalesce("revenue_share_claim", F.lit(0.0))).alias("revenue_share_claim"),
        F.max_by("evidence_quote", first).alias("evidence_quote"), F.max_by("evidence_source", first).alias("evidence_source"),
        F.array_sort(F.collect_list(F.struct(order, F.coalesce("segment_name", F.lit("")).alias("s"), F.coalesce("rationale", F.lit("")).alias("t")))).alias("_l"),
    )
    names = F.array_distinct(F.filter(F.transform("_l", lambda x: x["s"]), lambda s: s != ""))
    said = F.aggregate(F.transform("_l", lambda x: x["t"]), F.lit(""), lambda acc, t: F.when((t == "") | F.contains(acc, t), acc).when(acc == "", t).otherwise(F.substring(F.concat(acc, F.lit(" / "), t), 1, 200)))
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.greatest(F.col("_r"), F.lit(1)))
    return grouped.select(key, "theme_id", role.alias("role"), "confidence", "revenue_share_claim", "evidence_quote", "evidence_source", names.alias("segments"), said.alias("rationale"))


def judge(rows: DataFrame) -> DataFrame:
    """Verdicts over merged rows that carry known, cited, cited_as (source where it was found), sector_code, sector_ok, floor, actual, segments (names) and has_segments, unverified_segments.

    Only an unknown theme or a citation found nowhere rejects; the rest are flags and roles. Flags name what they saw after a colon.
    """
    c = F.col
    known, claim, core = F.coalesce("known", F.lit(False)), F.coalesce("revenue_share_claim", F.lit(0.0)), c("role") == "core"
    low = core & c("floor").isNotNull() & c("actual").isNotNull() & (c("actual") < c("floor"))
    claimed_low = core & c("floor").isNotNull() & c("actual").isNull() & (claim > 0) & (claim < c("floor"))
    silent = c("actual").isNull() & core & (claim == 0)
    verified = known & F.coalesce("cited", F.lit(False))
    lower = F.when(c("actual") >= c("floor") / 2, "adjacent").otherwise("peripheral")
    role = F.when(low, lower).when(claimed_low, "adjacent").otherwise(c("role"))
    evidence = F.when(c("actual").isNotNull(), F.when(low, "below_floor").otherwise("confirmed")).when(silent, "not_claimed").when(c("has_segments"), "not_found").when(c("unverified_segments"), "unverified").otherwise("unavailable")
    two = lambda x: F.format_string("%.2f", x.cast("double"))
    names = c("segments") if "segments" in rows.columns else F.array().cast("array<string>")
    lacking = F.when(c("has_segments"), F.when(F.size(names) > 0, F.concat(F.lit("segment_not_found:"), F.array_join(names, ","))).otherwise("segment_name_missing")).when(c("unverified_segments"), "segment_data_unverified").otherwise("segment_data_unavailable")
    flags = F.array_compact(F.array(
        F.when(c("cited_as") != c("evidence_source"), F.concat(F.lit("citation_source_mismatch:"), c("evidence_source"), F.lit("->"), c("cited_as"))),
        F.when(c("sector_code").isNotNull() & ~c("sector_ok"), "sector_conflict"), F.when(c("sector_code").isNull(), "sector_unknown"),
        F.when(F.abs(c("actual") - claim) > GAP, F.concat(F.lit("share_claim_gap:claim="), two(claim), F.lit("/actual="), two(c("actual")))),
        F.when(low, F.concat(F.lit("role_downgraded_by_actual:core->"), lower, F.lit("(actual="), two(c("actual")), F.lit("<"), c("floor").cast("string"), F.lit(")"))),
        F.when(c("actual").isNull(), lacking), F.when(claimed_low, F.concat(F.lit("role_downgraded:core->adjacent(claim="), two(claim), F.lit("<"), c("floor").cast("string"), F.lit(")"))), F.when(silent, "core_without_share_evidence"),
    ))
    return rows.select(
        "ticker", "theme_id", F.when(verified, role).otherwise(c("role")).alias("role"), F.when(verified, "verified").otherwise("rejected").alias("status"), F.when(~known, "unknown_theme").when(~verified, "hallucinated_citation").alias("reject_reason"), "confidence",
        F.when(verified, c("actual")).alias("actual_share"), F.when(verified & (claim != 0), claim).alias("claimed_share"), F.when(verified, evidence).otherwise("unavailable").alias("share_evidence"), F.when(verified, flags).otherwise(F.array().cast("array<string>")).alias("flags"),
    )


def verify_assignments(assignments: DataFrame, packs: DataFrame, taxonomy: list[Theme], universe: set[str]) -> DataFrame:
    """Verdicts from tagged assignments and evidence, nothing taken on trust: themes are looked up in the taxonomy, quotes in the
    claimed source and then in any, sectors in the theme's own, and the share is the sum of the segments named that are corroborated.

    assignments: ticker, theme_id, pos, role, confidence, evidence_quote, evidence_source, revenue_share_claim, segment_name, rationale; one
    row each, merged by ticker and theme first. packs: ticker, sector_code, business, segments_text, disclosures (text), segments
    (struct of segments and corroborated). Assignments of tickers without a pack are left out.
    """
    merged = merge_assignments(assignments).withColumn("evidence_source", F.coalesce("evidence_source", F.lit("business")))
    c = F.col
    rows = merged.join(packs.select("ticker", "sector_code", "business", "segments_text", "disclosures", F.col("segments").alias("_s")), "ticker")
    allowed = F.create_map(*[x for th in taxonomy for x in (F.lit(th.id), F.array(*[F.lit(s) for s in sorted(resolve_sectors(th.sectors, universe))]).cast("array<string>"))])
    floors = F.create_map(*[x for th in taxonomy for x in (F.lit(th.id), F.lit(th.floor).cast("double"))])
    found = F.coalesce(F.size("_s.segments") > 0, F.lit(False))
    sure = found & F.coalesce("_s.corroborated", F.lit(False))
    shares = F.filter(F.transform("segments", lambda n: share_of(F.col("_s.segments"), n)), lambda s: s.isNotNull())
    rows = rows.withColumns({
        "known": c("theme_id").isin(*[th.id for th in taxonomy]), "sector_ok": F.coalesce(F.array_contains(F.try_element_at(allowed, c("theme_id")), c("sector_code")), F.lit(False)), "floor": F.try_element_at(floors, c("theme_id")),
        "cited_as": cited_as(citation_key(c("evidence_quote")), c("evidence_source"), citation_key(c("business")), citation_key(c("segments_text")), citation_key(c("disclosures"))),
        "has_segments": sure, "unverified_segments": found & ~sure, "actual": F.when(sure & (F.size(shares) > 0), F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)),
    })
    return judge(rows.withColumn("cited", c("cited_as").isNotNull()))


def verification_metrics(verdicts: DataFrame) -> DataFrame:
    """kind, name, n: statuses, evidence and flags by what stands before their colon."""
    flags = verdicts.select(F.explode("flags").alias("f")).select(F.lit("flag").alias("kind"), F.split("f", ":")[0].alias("name"))
    rows = verdicts.select(F.lit("status").alias("kind"), F.col("status").alias("name")).unionByName(verdicts.filter("share_evidence IS NOT NULL").select(F.lit("evidence").alias("kind"), F.col("share_evidence").alias("name"))).unionByName(flags)
    return rows.groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))


def golden_scores(gold: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row over (ticker, theme) sets: tp, fp, fn, precision, recall, f1 and the share of wrong predictions; tickers outside the labels don't count."""
    inside = predicted.select("ticker", "theme").distinct().join(gold.select("ticker").distinct(), "ticker", "left_semi")
    want = gold.filter("theme IS NOT NULL").select("ticker", "theme").distinct()
    both = want.withColumn("g", F.lit(1)).join(inside.withColumn("p", F.lit(1)), ["ticker", "theme"], "full_outer")
    n = both.agg(F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn"))
    p, r = F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    return n.select("tp", "fp", "fn", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 4).alias("f1"), F.round(1 - p, 4).alias("misclassified"))


def golden_rows(labels: DataFrame, tags: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Seven rows of scores of core themes against labels (ticker, core, confidence, evidence_defect), of tagged tickers only.

    The first two are what the model chose, which a rerun reproduces; the others went through verification: all of it, sure
    labels only, shares confirmed by figures only, verdicts without a flag only, without labels whose evidence is defective.
    One pass: every (row, ticker) is a row with both sets of themes.
    """
    gold = labels.join(tags.select("ticker").distinct(), "ticker", "left_semi")
    gold = gold.select("ticker", F.coalesce("core", F.array().cast("array<string>")).alias("g"), (F.coalesce("confidence", F.lit("certain")) == "certain").alias("sure"), F.coalesce("evidence_defect", F.lit(False)).alias("defect"))
    core = lambda a: F.array_distinct(F.transform(F.filter(F.coalesce(a, F.array()), lambda x: x["role"] == "core"), lambda x: x["theme_id"]))
    said = tags.groupBy("ticker").agg(F.array_distinct(F.flatten(F.collect_list(core(F.col("assignments"))))).alias("said"))
    good = (F.col("status") == "verified") & (F.col("role") == "core")
    set_of = lambda c: F.collect_set(F.when(c, F.col("theme_id")))
    kept = verdicts.groupBy("ticker").agg(set_of(good).alias("kept"), set_of(good & (F.col("share_evidence") == "confirmed")).alias("confirmed"), set_of(good & (F.size("flags") == 0)).alias("clean"))
    wide = gold.join(said, "ticker", "left").join(kept, "ticker", "left")
    rows = [("before", "said", True, True), ("before, sure labels", "said", "sure", True), ("after", "kept", True, False), ("after, sure labels", "kept", "sure", False), ("after, shares confirmed", "confirmed", True, False), ("after, no flag", "clean", True, False), ("after, sound evidence", "kept", "sound", False)]
    use = {True: F.lit(True), "sure": F.col("sure"), "sound": ~F.col("defect")}
    each = wide.select("ticker", "g", F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(label).alias("label"), F.coalesce(F.col(p), F.array().cast("array<string>")).alias("p"), use[u].alias("use"), F.lit(same).alias("reproducible")) for k, (label, p, u, same) in enumerate(rows)])).alias("r")).select("ticker", "g", "r.*").filter("use")
    n = each.groupBy("place", "label", "reproducible").agg(
        F.count(F.lit(1)).alias("stocks"), F.sum(F.size(F.array_intersect("p", "g"))).alias("tp"), F.sum(F.size(F.array_except("p", "g"))).alias("fp"), F.sum(F.size(F.array_except("g", "p"))).alias("fn"),
        F.count_if(F.size("g") == 0).alias("empty"), F.count_if((F.size("g") == 0) & (F.size("p") == 0)).alias("abstained"),
    )
    p, r = (F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col(x)).cast("double")) for x in ("fp", "fn"))
    return n.select("place", "label", "reproducible", "stocks", "tp", "fp", "fn", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 4).alias("f1"), F.round(1 - p, 4).alias("misclassified"), F.concat_ws("/", "abstained", "empty").alias("correct_abstain"))


def top_errors(gold: DataFrame, predicted: DataFrame, top: int = 5) -> DataFrame:
    """error (fp or fn), theme, n: the themes most often predicted wrongly or missed."""
    want, got = gold.filter("theme IS NOT NULL").select("ticker", "theme").distinct(), predicted.select("ticker", "theme").distinct().join(gold.select("ticker").distinct(), "ticker", "left_semi")
    rows = got.join(want, ["ticker", "theme"], "left_anti").withColumn("error", F.lit("fp")).unionByName(want.join(got, ["ticker", "theme"], "left_anti").withColumn("error", F.lit("fn")))
    from pyspark.sql import Window

    counted = rows.groupBy("error", "theme").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy("error").orderBy(F.col("n").desc(), "theme"))).filter(F.col("rank") <= top)


def assert_cohort(gold: DataFrame, tagged: DataFrame, least: float = 0.8) -> None:
    """What is measured must be labelled: labels of tickers that weren't tagged do no harm."""
    mine = tagged.select("ticker").distinct()
    n, have = mine.count(), mine.join(gold.select("ticker").distinct(), "ticker", "left_semi").count()
    if n and have / n < least:
        raise ValueError(f"only {have} of {n} tagged tickers are labelled")
