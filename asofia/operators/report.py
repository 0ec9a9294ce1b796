"""Roll-ups and the Markdown digest. Only small, ranked frames reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from asofia.operators.catalysts import CHECKS, live, top_per_kind


def roll_up(rows: DataFrame, keys: list[str], value: str, thing: str) -> DataFrame:
    """size, different things and mean by keys."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(thing).alias("things"), F.avg(value).alias("mean"))


def failed(df: DataFrame) -> DataFrame:
    """The names of the checks that don't hold."""
    return df.withColumn("failed", F.array_compact(F.array(*[F.when(~F.col(k), F.lit(k)) for k in CHECKS])))


WHY = {"unverified": "table of percentages only", "unavailable": "no segments reported", "not_found": "no such segment", "not_claimed": "no share claimed"}


def share_text(row: Row) -> str:
    """A share with its source, never a grade: what figures say, else what was claimed and why figures can't say."""
    why = WHY.get(row["share_evidence"] or "", "unconfirmed")
    if row["actual_share"] is not None:
        return f"{row['actual_share']:.0%} (reported)"
    return f"~{row['claimed_share']:.0%} (claimed, {why})" if row["claimed_share"] else why


def digest(verdicts: DataFrame, metrics: DataFrame, catalysts: DataFrame, max_groups: int = 2, per_theme: int = 20, per_kind: int = 15, *, title: str = "Digest", survivorship: dict | None = None, golden: list[dict] | None = None, quality: dict | None = None, funnel: dict | None = None) -> str:
    """Markdown: what passed each step, verified stocks by theme with their events, counter-events first, those held back for their
    risk groups, events, and appendices: rejected assignments, weak and expired events, data defects, golden scores, survivorship."""
    good = verdicts.filter("status = 'verified' AND role = 'core'").join(metrics.select("ticker", "n_risk_groups", "score"), "ticker", "left").withColumn("held", F.coalesce(F.col("n_risk_groups") >= max_groups, F.lit(False)))
    fresh = live(catalysts)
    marks = fresh.groupBy("ticker").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("polarity") == "negative", F.concat(F.lit("**"), "kind", F.lit("**"))))), " ").alias("against"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("polarity") == "positive", F.col("kind")))), " ").alias("pro"))
    best = good.withColumn("place", F.row_number().over(Window.partitionBy("theme_id", "held").orderBy(F.col("score").desc_nulls_last(), "ticker"))).filter(F.col("place") <= per_theme).join(marks, "ticker", "left").orderBy("held", "theme_id", "place")
    n = verdicts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "verified").alias("ok"), F.count_if(F.col("reject_reason") == "hallucinated_citation").alias("made_up"), F.count_if(F.col("reject_reason") == "unknown_theme").alias("unknown"), F.count_if((F.col("status") == "verified") & (F.col("role") == "core")).alias("core")).first()
    out = [f"# {title}", ""]
    if funnel:
        out += [f"Universe {funnel.get('universe', '?')}, past the guards {funnel.get('eligible', '?')}, on the screen {funnel.get('final', '?')}, verified core assignments {n['core']}.", ""]
    out += [f"Assignments: {n['n']}, of which {n['ok']} verified and {n['n'] - n['ok']} rejected ({n['made_up']} citations found nowhere, {n['made_up'] / n['n'] if n['n'] else 0:.2%}).", ""]
    now = None
    for r in best.collect():  # per_theme rows a theme
        head = "## Held back" if r["held"] else f"## {r['theme_id']}"
        if head != now:
            out += [head, ""]
            now = head
        events = " ".join(x for x in (r["against"], r["pro"]) if x)
        out.append(f"- {r['ticker']} ({share_text(r)}{', risk groups: ' + str(r['n_risk_groups']) if r['n_risk_groups'] else ''}{', events: ' + events if events else ''})")
    for head, polarity in (("Counter-events", "negative"), ("Events", "positive")):
        shown = top_per_kind(failed(fresh.filter(F.col("polarity") == polarity)), per_kind).orderBy("kind", "rank").collect()  # per_kind rows a kind
        out += ["", f"## {head}", ""] + [f"- {r['kind']} {r['ticker']} {r['rcept_dt']} {r['confidence']}/6" + (f" (fails {', '.join(r['failed'])})" if r["failed"] else "") for r in shown]
        out += [f"- {r['kind']}: +{r['more']} more" for r in {r["kind"]: r for r in shown}.values() if r["more"]]
    gone = catalysts.agg(F.count_if(~F.col("not_expired")).alias("old"), F.count_if(F.col("not_expired") & (F.col("confidence") < 4)).alias("weak")).first()
    out += ["", "## Appendix", "", f"Rejected for an unknown theme: {n['unknown']}.", f"Expired events: {gone['old']}", f"Weak events: {gone['weak']}"]
    out += [f"Defects: {', '.join(f'{k} {v}' for k, v in quality.items() if v)}"] if quality else []
    out += [f"Golden, {g['label']}: precision {g['precision']}, recall {g['recall']}, misclassified {g['misclassified']}" + ("" if g["reproducible"] else " (a rerun gives another figure)") for g in golden or []]
    if survivorship and survivorship.get("missing"):
        out.append(f"Survivorship: {survivorship['missing']} of {survivorship['listed']} lines listed then have no financials (coverage {survivorship['coverage']}).")
    return "\n".join([*out, "", "Made by machine from filings. Not advice.", ""])
