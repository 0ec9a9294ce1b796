"""Command line over the library: python -m asofia --help.

What talks to outside services writes raw files; every command reads those or the store. Results go below the store, by
date and screen, unless a folder is named. A step whose inputs lack is an error, never skipped.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofia import config, schemas
from asofia.functions.dates import fiscal_end
from asofia.operators import catalysts, checks, documents, gate, metrics, periods, pit, prices, report, themes, universe, verify
from asofia.session import ready
from asofia.sources import readers
from asofia.sources.store import TABLES, Store


def _spark() -> SparkSession:
    return ready(SparkSession.builder.appName("asofia").config("spark.sql.session.timeZone", "UTC").getOrCreate())


class Place:
    """Where a command finds and leaves things."""

    def __init__(self, spark: SparkSession, a: argparse.Namespace):
        self.spark, self.a, self.root = spark, a, a.store.rstrip("/")
        self._store: Store | None = None

    @property
    def store(self) -> Store:
        self._store = self._store or Store(self.spark, self.root)
        return self._store

    def at(self, kind: str, screen: bool = True) -> str:
        return "/".join([self.root, "out", str(self.a.as_of), *([self.a.screen] if screen else []), kind])

    def read(self, kind: str, screen: bool = True) -> DataFrame:
        return self.spark.read.parquet(self.at(kind, screen))

    def write(self, df: DataFrame, kind: str, screen: bool = True) -> DataFrame:
        df.write.mode("overwrite").parquet(self.at(kind, screen))
        return self.read(kind, screen)

    def say(self, **value: object) -> int:
        print(json.dumps(value, ensure_ascii=False, default=str))
        return 0


def _taxonomy(p: Place) -> tuple[list[themes.Theme], set[str]]:
    raw = config.read(p.a.taxonomy)
    sectors = set(raw["sectors"])
    return config.taxonomy(raw, sectors), sectors


def init(p: Place) -> int:
    p.store
    return p.say(tables=sorted(TABLES))


def status(p: Place) -> int:
    return p.say(**{n: p.store.read(n).count() for n in TABLES})


def ingest(p: Place) -> int:
    rows = p.spark.read.parquet(p.a.path)
    if p.a.table in ("facts", "disclosures"):
        return p.say(added=getattr(p.store, f"append_{p.a.table}")(rows))
    p.store.upsert(p.a.table, rows)
    return p.say(rows=p.store.read(p.a.table).count())


def ingest_master(p: Place) -> int:
    rules = [tuple(r) for r in config.read(p.a.sectors)["rules"]]
    p.store.upsert("master", universe.annotate(p.spark.read.schema(schemas.MASTER).json(p.a.path), rules))
    return p.say(sectors={r["sector_code"] or "unmapped": r["n"] for r in universe.sector_coverage(p.store.read("master")).collect()})


def _filings(p: Place) -> DataFrame:
    """Raw payloads below folders ticker=.../statement_basis=.../; reported_at comes from the receipt number."""
    rows = readers.filings(p.spark, p.a.path)
    named = F.regexp_extract("file", "ticker=([^/]+)/", 1), F.regexp_extract("file", "statement_basis=([^/]+)/", 1)
    return periods.normalize_filings(rows.select(named[0].alias("ticker"), named[1].alias("statement_basis"), F.lit(None).cast("date").alias("reported_at"), F.lit(None).cast("string").alias("revision_of"), "list"), p.a.lag)


def ingest_dart(p: Place) -> int:
    chosen = universe.eligible(p.store.read("master"), p.a.listed_before, seed=p.a.seed, sample=p.a.sample, head=p.a.limit, tickers=p.a.tickers)
    rows = _filings(p).join(chosen.select("ticker"), "ticker", "left_semi").filter((F.col("fiscal_year") <= p.a.year) & (F.col("fiscal_quarter") <= p.a.quarter))
    return p.say(added=p.store.append_facts(rows))


def renormalize(p: Place) -> int:
    p.store.replace("facts", _filings(p))
    return p.say(facts=p.store.read("facts").count())


def _annual(rows: DataFrame, year: int) -> DataFrame:
    """Rows of a year's report as facts."""
    end = fiscal_end(F.lit(year), F.lit(12))
    full = rows.withColumns({"fiscal_year": F.lit(year), "fiscal_end_date": end, "period_type": F.lit("FY"), "statement_basis": F.lit("CFS"), "market": F.lit("KR")})
    return full.withColumn("fact_id", pit.fact_id(*[F.col(c) for c in ("ticker", "element", "fiscal_end_date", "period_type", "statement_basis", "source_doc_id")]))


def ingest_dividend(p: Place) -> int:
    return p.say(added=p.store.append_facts(_annual(readers.dividends(p.spark.read.parquet(p.a.path), p.a.lag), p.a.year)))


def ingest_holder(p: Place) -> int:
    raw = p.spark.read.parquet(p.a.path)
    stakes = readers.owner_stakes(raw).join(raw.groupBy("ticker").agg(F.max("rcept_no").alias("source_doc_id")), "ticker")
    day = F.to_date(F.substring("source_doc_id", 1, 8), "yyyyMMdd")
    rows = stakes.select("ticker", F.lit("OWNER_STAKE_PCT").alias("element"), F.col("stake").alias("value"), "source_doc_id", day.alias("reported_at"), F.date_add(day, p.a.lag).alias("available_at"))
    return p.say(added=p.store.append_facts(_annual(rows, p.a.year)))


def ingest_delisting(p: Place) -> int:
    raw = p.spark.read.schema(schemas.DELISTINGS).json(p.a.path)
    if p.a.include_all_types:
        raw = raw.withColumn("secu_group", F.lit("주권"))
    p.store.upsert("delistings", readers.delistings(raw))
    return p.say(rows=p.store.read("delistings").count())


def ingest_disclosures(p: Place) -> int:
    rows = readers.disclosures(p.spark.read.json(p.a.path))
    end = p.a.end or date.today()
    day = F.col("rcept_dt")
    rows = rows.filter((day >= F.lit(p.a.begin or end - timedelta(days=p.a.lookback))) & (day <= F.lit(end)) & F.col("pblntf_ty").isin(*(p.a.types or ["B", "I"])))
    return p.say(added=p.store.append_disclosures(rows))


def ingest_prices(p: Place) -> int:
    own = readers.prices_csv(p.spark, p.a.csv).filter(F.col("date") <= F.lit(p.a.as_of))
    last = pit.prices_asof(own, p.a.as_of)
    if p.a.with_facts:
        last = last.join(p.store.read("facts").select("ticker").distinct(), "ticker", "left_semi")
    other = pit.prices_asof(readers.prices_csv(p.spark, p.a.cross_check), p.a.as_of) if p.a.cross_check else None
    both = prices.reconcile(last, other)
    rows = both.withColumns({"market_cap_common": F.col("cap"), "price_date": F.col("date"), "source": F.lit(p.a.source), "date": F.lit(p.a.as_of)})
    mean = own.groupBy("ticker").agg(F.avg(F.when(F.col("date") > F.date_sub(F.lit(p.a.as_of), 30), F.col("close") * F.col("volume"))).alias("adtv_20d"))
    p.store.upsert("prices", rows.join(mean, "ticker", "left"))
    n = both.agg(F.count(F.lit(1)).alias("rows"), F.count_if("compared").alias("compared"), F.count_if("disagrees").alias("disagree")).first()
    return p.say(**n.asDict())


def probe_price(p: Place) -> int:
    rows = readers.prices_csv(p.spark, p.a.csv).withColumn("price_date", F.col("date")).filter(F.col("date") <= F.lit(p.a.as_of))
    got = prices.probe(rows.filter(F.col("ticker").isin(p.a.tickers)) if p.a.tickers else rows)
    p.say(**got)
    return 0 if got["ok"] else 1


def survivorship(p: Place) -> int:
    s = p.store
    return p.say(**pit.survivorship(s.read("master"), s.read("delistings"), s.read("facts"), p.a.as_of).first().asDict())


def derive(p: Place) -> int:
    day, s = p.a.as_of, p.store
    facts = pit.facts_asof(s.read("facts"), day)
    price = pit.prices_asof(s.read("prices"), day).withColumn("treasury_shares", F.col("shares_treasury"))
    wide = p.write(metrics.assemble(facts, price, s.read("master"), day, pit.status_asof(s.read("status"), day)), "metrics", False)
    metrics.assert_sane(wide, ["per", "pbr", "roe", "op_margin", "market_cap_used"])
    return p.say(rows=wide.count(), defects=metrics.defect_counts(wide, metrics.FLAGS, ["per", "pbr"]).first().asDict())


def _wanted(p: Place, columns: list[str]) -> list[checks.Check]:
    """The screen's checks, switched as asked; one whose source has no facts at the date is left out, one whose column lacks is an error."""
    chosen = checks.override(checks.of_screen(p.a.screen), tuple(p.a.enable or ()), tuple(p.a.disable or ()))
    have = universe.available_sources(p.store.read("facts"), p.a.as_of, checks.SOURCES) if p.a.sources is None else set(p.a.sources)
    return checks.runnable(chosen, columns, have)


def screen(p: Place) -> int:
    df = p.spark.read.parquet(p.a.metrics) if p.a.metrics else p.read("metrics", False)
    g = gate.resolve(p.a.screen)
    wanted = _wanted(p, df.columns)
    if p.a.preview:
        for c in wanted:
            p.say(**checks.preview(df, c).first().asDict())
        return 0
    g = replace(g, filters=(*g.filters, *checks.gate_filters(wanted)), target=p.a.target or g.target)
    metrics.assert_sane(df, [f.metric for f in g.filters])
    checks.assert_coverage(df, wanted)
    df, hard = checks.guard_columns(df, wanted)
    df = checks.risk_groups(checks.apply(df, [c for c in wanted if c.id not in hard]), [c for c in wanted if c.id not in hard])
    good, why = gate.guard(df, [*gate.SCREEN_GUARDS[p.a.screen], *hard], gate.MIN_CAP[p.a.screen], gate.SCREEN_SECTORS[p.a.screen])
    basket = p.a.basket or f"{p.root}/basket-{p.a.screen}.json"
    held, _ = readers.load_basket(basket)
    best, manifest = gate.run(good, g, p.spark.createDataFrame([(x,) for x in sorted(held)], "ticker string"))
    best = p.write(best, "survivors")
    p.write(why, "why_excluded")
    manifest |= {"universe": df.count(), "eligible": good.count(), "final": best.count(), "guards": gate.SCREEN_GUARDS[p.a.screen], "checks": [c.id for c in wanted]}
    readers.write_json(p.at("manifest.json"), manifest)
    if p.a.rebalance:
        readers.save_basket(basket, [r["ticker"] for r in best.select("ticker").collect()], str(p.a.as_of))  # at most the gate's cap
    return p.say(**manifest)


def list_checks(p: Place) -> int:
    have = universe.available_sources(p.store.read("facts"), p.a.as_of, checks.SOURCES) if p.a.as_of else None
    for c in checks.of_screen(p.a.screen):
        p.say(id=c.id, kind=c.kind, polarity=c.polarity, enabled=c.enabled, group=c.risk_group, source=c.source, available=None if have is None else c.source is None or c.source in have)
    return 0


def enrich(p: Place) -> int:
    day = p.a.as_of
    chosen = p.read("survivors").orderBy("rank").select("ticker", "sector_code", "revenue_ttm")
    chosen = chosen.limit(p.a.limit) if p.a.limit else chosen
    filing = universe.latest_filing(p.store.read("facts"), day).select("ticker", F.col("source_doc_id").alias("rcept_no"))
    texts = chosen.join(filing, "ticker").join(readers.documents(p.spark, p.a.documents), "rcept_no")
    packs = documents.evidence(texts.select("ticker", "text", F.col("revenue_ttm").alias("revenue")), p.a.max_chars).join(chosen.select("ticker", "sector_code"), "ticker")
    titles = pit.disclosures_asof(p.store.read("disclosures"), day, day - timedelta(days=180)).groupBy("ticker").agg(F.array_join(F.array_sort(F.collect_list("report_nm")), " ").alias("disclosures"))
    packs = packs.join(titles, "ticker", "left").withColumn("disclosures", F.coalesce("disclosures", F.lit("")))
    packs = packs.withColumn("pack_hash", documents.pack_hash(F.col("ticker"), F.col("business"), F.col("segments_text"), F.col("disclosures")))
    return p.say(packs=p.write(packs, "packs").count())


def tag(p: Place) -> int:
    """Candidates and what the calls would cost; the calls themselves are made elsewhere, their results read by verify."""
    taxonomy, sectors = _taxonomy(p)
    packs = p.read("packs")
    text = F.concat_ws("\n", "business", "segments_text")
    found = p.write(themes.candidates(packs, taxonomy, sectors, text, F.col("sector_code"), "ticker"), "candidates")
    return p.say(candidates=found.count(), **themes.cost_estimate(packs, text).first().asDict())


def _tags(p: Place) -> DataFrame:
    return p.spark.read.schema(schemas.TAGS).json(p.a.tags)


def verify_tags(p: Place) -> int:
    taxonomy, sectors = _taxonomy(p)
    rows = _tags(p).filter("NOT coalesce(abstain, false)").select("ticker", F.posexplode("assignments").alias("pos", "a")).select("ticker", "pos", "a.*")
    verdicts = p.write(verify.verify_assignments(rows, p.read("packs"), taxonomy, sectors), "verdicts")
    n = verdicts.count()
    bad = verdicts.filter("reject_reason = 'hallucinated_citation'").count()
    return p.say(assignments=n, hallucinated_citation_rate=round(bad / n, 4) if n else None, counts=[r.asDict() for r in verify.verification_metrics(verdicts).orderBy("kind", "name").collect()])


def golden(p: Place) -> int:
    labels, tags = readers.one_label_each(*[readers.labels(p.spark, f) for f in p.a.golden]), _tags(p)
    if not p.a.allow_cohort_drift:
        verify.assert_cohort(labels, tags)
    rows = verify.golden_rows(labels, tags, p.read("verdicts")).orderBy("place").collect()  # seven
    readers.write_json(p.at("golden.json"), [r.asDict() for r in rows])
    for r in rows:
        p.say(**r.asDict())
    return 0


def find_catalysts(p: Place) -> int:
    day = p.a.as_of
    events = pit.disclosures_asof(p.store.read("disclosures"), day, day - timedelta(days=p.a.lookback))
    wide = p.read("metrics", False)
    if not p.a.all_universe:
        events = events.join(p.read("survivors").select("ticker"), "ticker", "left_semi")
    found = catalysts.classify(events).withColumns({"raw": F.lit(None).cast("double"), "stated_expiry": F.lit(None).cast("date")})
    if p.a.amounts:  # rcept_no, raw, stated_expiry, as read from the filings
        found = found.drop("raw", "stated_expiry").join(p.spark.read.schema("rcept_no string, raw double, stated_expiry date").json(p.a.amounts), "rcept_no", "left")
    rows = p.write(catalysts.keep(catalysts.build(found, wide, catalysts.amendments(events), day)), "catalysts")
    return p.say(events=rows.count(), whole=rows.filter("confidence = 6").count())


def write_report(p: Place) -> int:
    best, s = p.read("survivors").select("ticker", "score", "n_risk_groups"), p.store
    quality = metrics.defect_counts(p.read("metrics", False), metrics.FLAGS, []).first().asDict()
    then = pit.survivorship(s.read("master"), s.read("delistings"), s.read("facts"), p.a.as_of).first().asDict()
    text = report.digest(
        p.read("verdicts"), best, p.read("catalysts"), gate.MAX_RISK_GROUPS[p.a.screen], title=f"{p.a.screen} {p.a.as_of}", funnel=readers.read_json(p.at("manifest.json")), quality=quality, golden=readers.read_json(p.at("golden.json")), survivorship=then
    )
    readers.write_text(p.at("digest.md"), text)
    return p.say(characters=len(text))


def query(p: Place) -> int:
    from asofia.plans import queries

    queries.QUERIES[p.a.name](p.spark, p.a.folder).write.mode("overwrite").parquet(p.a.out)
    return 0


#: Command -> function and arguments: name, kind (day, int, flag, list, adds, text) and default; ! must be given, a bare word is a place.
_DAY, _SCREEN = "as-of:day!", "screen:screen=deep_value"
COMMANDS: dict[str, tuple[Callable[[Place], int], str]] = {
    "init": (init, ""),
    "status": (status, ""),
    "ingest": (ingest, "table path"),
    "ingest-master": (ingest_master, "path=raw/master sectors=sectors.json"),
    "ingest-dart": (ingest_dart, "path=raw/filings year:int! quarter:int! limit:int sample:int seed:int=42 listed-before:day tickers:list lag:int=1"),
    "renormalize": (renormalize, "path=raw/filings lag:int=1"),
    "ingest-dividend": (ingest_dividend, "path=raw/dividend year:int! lag:int=1"),
    "ingest-holder": (ingest_holder, "path=raw/holder year:int! lag:int=1"),
    "ingest-delisting": (ingest_delisting, "path=raw/delisting include-all-types:flag"),
    "ingest-disclosures": (ingest_disclosures, "path=raw/disclosures lookback:int=180 begin:day end:day types:list"),
    "ingest-prices": (ingest_prices, f"{_DAY} csv=raw/prices.csv source=csv cross-check with-facts:flag"),
    "probe-price": (probe_price, f"{_DAY} csv=raw/prices.csv tickers:list"),
    "survivorship": (survivorship, _DAY),
    "derive": (derive, _DAY),
    "screen": (screen, f"{_DAY} {_SCREEN} metrics= basket= target:int sources:list enable:adds disable:adds rebalance:flag preview:flag"),
    "checks": (list_checks, f"as-of:day {_SCREEN}"),
    "enrich": (enrich, f"{_DAY} {_SCREEN} documents=raw/documents limit:int max-chars:int=12000"),
    "tag": (tag, f"{_DAY} {_SCREEN} taxonomy=taxonomy.json"),
    "verify": (verify_tags, f"{_DAY} {_SCREEN} taxonomy=taxonomy.json tags=raw/tags"),
    "golden": (golden, f"{_DAY} {_SCREEN} tags=raw/tags golden:list=golden.jsonl allow-cohort-drift:flag"),
    "catalysts": (find_catalysts, f"{_DAY} {_SCREEN} lookback:int=180 all-universe:flag amounts="),
    "report": (write_report, f"{_DAY} {_SCREEN}"),
    "query": (query, "name folder out"),
}
_PLACES = {"table", "path", "name", "folder", "out"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="asofia")
    top.add_argument("--store", default="store")
    commands = top.add_subparsers(dest="command", required=True)
    kinds = {"int": {"type": int}, "day": {"type": date.fromisoformat}, "flag": {"action": "store_true"}, "list": {"nargs": "*"}, "adds": {"action": "append"}, "screen": {"choices": sorted(gate.SCREENS)}, "text": {}}
    for command, (fn, spec) in COMMANDS.items():
        c = commands.add_parser(command)
        c.set_defaults(fn=fn)
        for word in spec.split():
            must = word.endswith("!")
            name, _, default = word.rstrip("!").partition("=")
            name, _, kind = name.partition(":")
            if word in _PLACES:
                c.add_argument(name, **({"choices": sorted(TABLES)} if name == "table" else {}))
                continue
            how = dict(kinds[kind or "text"])
            if must:
                how["required"] = True
            if default:
                how["default"] = [default] if kind == "list" else how.get("type", str)(default)
            c.add_argument(f"--{name}", **how)
    return top


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    return a.fn(Place(_spark(), a))


if __name__ == "__main__":
    raise SystemExit(main())
