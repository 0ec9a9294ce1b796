"""Theme taxonomy: candidates, validation, escalation, cost estimates, tag cache."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from asofia import schemas

TOP = 6
KEYWORD_LIMIT = 20_000


@dataclass(frozen=True)
class Theme:
    id: str
    sectors: str | tuple[str, ...] = "ANY"  # ANY, a list, or NOT [...]
    floor: float | None = None
    keywords: tuple[str, ...] = ()
    definition: str = ""
    derivation: str = "llm"


def resolve_sectors(spec: str | tuple[str, ...] | list[str] | None, universe: set[str]) -> set[str]:
    if spec is None or spec == "ANY":
        return set(universe)
    if isinstance(spec, str):
        m = re.fullmatch(r"NOT\s*\[(.*)\]", spec.strip())
        if not m:
            raise ValueError(f"not a sector rule: {spec!r}")
        return universe - {x.strip() for x in m[1].split(",") if x.strip()}
    return set(spec) & universe


def validate(themes: list[Theme], universe: set[str]) -> list[str]:
    """Errors: ids, definitions, shares, sectors, duplicates, shared keywords and likeness of keyword sets."""
    out, owners = [], {}
    for t in themes:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", t.id):
            out.append(f"{t.id}: not snake case")
        if len(t.definition) < 25:
            out.append(f"{t.id}: definition too short")
        if t.floor is not None and not 0 < t.floor <= 1:
            out.append(f"{t.id}: share {t.floor}")
        if not isinstance(t.sectors, str) and (unknown := set(t.sectors) - universe):
            out.append(f"{t.id}: unknown sectors {sorted(unknown)}")
        if not resolve_sectors(t.sectors, universe):
            out.append(f"{t.id}: no sector")
        for k in set(t.keywords):
            owners.setdefault(k, set()).add(t.id)
    ids = [t.id for t in themes]
    out += [f"{i}: twice" for i in sorted({i for i in ids if ids.count(i) > 1})]
    out += [f"keyword {k}: {len(o)} themes" for k, o in sorted(owners.items()) if len(o) > 3]
    for i, a in enumerate(themes):
        for b in themes[i + 1 :]:
            x, y = set(a.keywords), set(b.keywords)
            if x and y and len(x & y) / len(x | y) >= 0.35:
                out.append(f"{a.id} and {b.id}: alike")
    return out


def taxonomy_block(themes: list[Theme]) -> str:
    """The same text for the same taxonomy: model-derived themes by id."""
    return "\n".join(f"{t.id}: {t.definition}" for t in sorted(themes, key=lambda t: t.id) if t.derivation == "llm")


def candidates(packs: DataFrame, themes: list[Theme], universe: set[str], text: Column, sector: Column, key: str = "ticker", top: int = TOP) -> DataFrame:
    """key, theme_id, hits, score, rank: keywords found in the text, plus a half for an allowed sector; the best few themes, ties in the taxonomy's order.

    The taxonomy is compiled into one expression over the text, so nothing is joined.
    """
    if sum(len(t.keywords) for t in themes) > KEYWORD_LIMIT:
        raise ValueError("too many keywords for one expression")
    scored = []
    for k, t in enumerate(t for t in themes if t.derivation == "llm"):
        hits = F.lit(0)
        if t.keywords:
            hits = F.size(F.filter(F.array(*[F.lit(w) for w in t.keywords]), lambda w: F.contains(text, w)))
        fits = F.coalesce(sector.isin(*sorted(resolve_sectors(t.sectors, universe))), F.lit(False))
        scored.append(F.struct(F.lit(t.id).alias("theme_id"), hits.cast("int").alias("hits"), (hits + F.when(fits, 0.5).otherwise(0.0)).cast("double").alias("score"), F.lit(k).alias("place")))
    rows = packs.select(key, F.explode(F.array(*scored)).alias("c")).select(key, "c.*").filter("score > 0")
    best = Window.partitionBy(key).orderBy(F.col("score").desc(), "place")
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).drop("place")


def keyword_likeness(keywords: DataFrame, least: float = 0.35) -> DataFrame:
    """a, b, jaccard of themes (theme_id, keywords) that share a keyword: joined on it, so pairs without one never arise."""
    one = keywords.select("theme_id", F.explode(F.array_distinct("keywords")).alias("k"))
    size = keywords.select("theme_id", F.size(F.array_distinct("keywords")).alias("n"))
    pairs = one.select(F.col("theme_id").alias("a"), "k").join(one.select(F.col("theme_id").alias("b"), "k"), "k").filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    both = pairs.join(size.select(F.col("theme_id").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("theme_id").alias("b"), F.col("n").alias("nb")), "b")
    return both.withColumn("jaccard", F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).filter(F.col("jaccard") >= least).select("a", "b", "jaccard")


def escalate(tags: DataFrame, confident: float = 0.75, apart: float = 0.2) -> DataFrame:
    """reason why a result goes to the better model, else null: a newly proposed theme; then the first assignment that gives
    one: low confidence, a core role, or a claimed revenue share that is far from the segment's (theme_segment_share, by theme)."""
    named = {f.name for f in tags.schema["assignments"].dataType.elementType.fields}

    def why(x: Column) -> Column:
        out = F.when(x["confidence"] < confident, "low_confidence").when(x["role"] == "core", "core_assignment")
        if "theme_segment_share" in tags.columns and "revenue_share_claim" in named:
            out = out.when(F.abs(x["revenue_share_claim"] - F.try_element_at(F.col("theme_segment_share"), x["theme_id"])) > apart, "share_mismatch")
        return out

    first = F.try_element_at(F.array_compact(F.transform(F.coalesce("assignments", F.array()), why)), F.lit(1))
    proposed = F.length(F.coalesce("proposed_new_theme", F.lit(""))) > 0 if "proposed_new_theme" in tags.columns else F.lit(False)
    return tags.withColumn("reason", F.when(proposed, "proposed_new_theme").otherwise(first))


def cache_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\0", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def cache_misses(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    return wanted.join(cache.select("key").distinct(), "key", "left_anti")


def fingerprint(rules: str, themes: list[Theme]) -> str:
    """Of everything that stands before a company: a change of rules or taxonomy makes other cache keys."""
    return hashlib.sha256(f"{rules}\0{taxonomy_block(themes)}".encode()).hexdigest()[:16]


def requests(packs: DataFrame, found: DataFrame, rules: str, themes: list[Theme], model: str) -> DataFrame:
    """custom_id, key and body (JSON) of a batch: packs (ticker, name, sector_code, business, segments_text, disclosures, pack_hash) that
    have candidates (ticker, theme_id, rank). What stands first is the same for all, so that it can be cached by whoever answers."""
    ids = found.groupBy("ticker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "theme_id"))), lambda x: x["theme_id"]), ", ").alias("ids"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    parts = [F.lit("candidates: "), F.col("ids"), F.lit("\nticker: "), text("ticker"), F.lit("\nname: "), text("name"), F.lit("\nsector: "), text("sector_code"), F.lit("\n\nbusiness:\n"), text("business"), F.lit("\n\nsegments:\n"), text("segments_text"), F.lit("\n\ndisclosures:\n"), text("disclosures")]
    system = f"{rules}\n\n{taxonomy_block(themes)}"
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(system).alias("system"), F.concat(*parts).alias("user")))
    return packs.join(ids, "ticker").select(F.concat(F.lit("tag-"), "ticker").alias("custom_id"), cache_key(F.col("pack_hash"), F.lit(fingerprint(rules, themes)), F.lit(model)).alias("key"), body.alias("body"))


def results(answers: DataFrame) -> DataFrame:
    """ticker, assignments, abstain, error of a batch's answers (custom_id, type, text): an answer that failed or can't be read abstains and says why."""
    tags = F.from_json("text", T.StructType([*schemas.TAGS.fields[1:], T.StructField("proposed_new_theme", T.StringType())]))
    rows = answers.withColumn("_t", tags).withColumn("error", F.when(F.col("type") != "succeeded", F.col("type")).when(F.col("_t.assignments").isNull() & ~F.coalesce("_t.abstain", F.lit(False)), "unreadable"))
    none = F.array().cast(schemas.TAGS["assignments"].dataType)
    good = F.col("error").isNull()
    return rows.select(
        F.regexp_replace("custom_id", "^tag-", "").alias("ticker"), F.when(good, F.coalesce("_t.assignments", none)).otherwise(none).alias("assignments"), (~good | F.coalesce("_t.abstain", F.lit(False))).alias("abstain"), F.when(good, F.col("_t.proposed_new_theme")).alias("proposed_new_theme"), "error"
    )


def cost_estimate(packs: DataFrame, text: Column, escalation: float = 0.3, output_tokens: int = 400, chars_per_token: float = 2.2) -> DataFrame:
    tokens = F.sum(F.ceil(F.length(text) / chars_per_token))
    return packs.agg(F.count(F.lit(1)).alias("n"), tokens.alias("input_tokens"), (F.count(F.lit(1)) * output_tokens).alias("output_tokens"), F.ceil(F.count(F.lit(1)) * escalation).alias("escalated"))
