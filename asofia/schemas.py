"""Every table's schema. Money is double; missing is null, never NaN."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "d": T.DateType(), "t": T.TimestampType(), "f": T.DoubleType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType()}


def schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in columns.items()])


FACTS = schema(
    fact_id="s", ticker="s", market="s", corp_code="s", fiscal_year="i", fiscal_quarter="i", fiscal_end_date="d", period_type="s", period_months="i", reported_at="d",
    available_at="d", ingested_at="t", statement_basis="s", element="s", value="f", currency="s", source_doc_id="s", source_url="s", revision_of="s", amount_field="s",
)
PRICES = schema(date="d", ticker="s", close="f", shares_common="l", shares_other="l", shares_treasury="l", market_cap_common="f", market_cap_total="f", adtv_20d="f", price_date="d", source="s")
MASTER = schema(ticker="s", name="s", market="s", corp_code="s", industry="s", sector_code="s", fiscal_month="i", listing_date="d", is_spac="b", is_reit="b", is_preferred="b", is_holding="b", is_financial="b")
STATUS = schema(ticker="s", status="s", effective_from="d", reason="s", source="s", snapshot_date="d")
DISCLOSURES = schema(rcept_no="s", ticker="s", corp_code="s", corp_name="s", corp_cls="s", report_nm="s", report_key="s", is_amendment="b", pblntf_ty="s", rcept_dt="d", flr_nm="s")
DELISTINGS = schema(ticker="s", name="s", market="s", secu_group="s", listing_date="d", delisting_date="d", reason="s", outcome="s", to_ticker="s", to_name="s", snapshot_date="d")
ASSIGNMENT = T.StructType(list(schema(theme_id="s", role="s", rationale="s", evidence_quote="s", evidence_source="s", revenue_share_claim="f", segment_name="s", confidence="f")))
TAGS = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("assignments", T.ArrayType(ASSIGNMENT)), T.StructField("abstain", T.BooleanType())])
SEGMENT = schema(name="s", share="f", amount="s", path="s")
SEGMENTS = T.StructType([T.StructField("segments", T.ArrayType(SEGMENT)), *schema(complete="b", corroborated="b", method="s", source_line="s")])
PACK = T.StructType([*schema(ticker="s", business="s", segments_text="s"), T.StructField("segments", SEGMENTS), T.StructField("disclosures", T.ArrayType(schema(date="d", title="s")))])
VERDICT = T.StructType([*schema(ticker="s", theme_id="s", role="s", status="s", reject_reason="s", confidence="f", actual_share="f", claimed_share="f", share_evidence="s"), T.StructField("flags", T.ArrayType(T.StringType())), T.StructField("segments", T.ArrayType(T.StringType()))])
CATALYSTS = schema(ticker="s", kind="s", rcept_no="s", occurred_at="d", expires_at="d", magnitude="f", magnitude_basis="s", grounded="b", material="b", no_reversal="b", not_amended="b", not_expired="b", numbers_agree="b", confidence="i")
LABELS = T.StructType([*schema(ticker="s", name="s"), T.StructField("core", T.ArrayType(T.StringType())), *schema(confidence="s", note="s", evidence_defect="b")])
FILING_LINE = schema(rcept_no="s", reprt_code="s", bsns_year="s", corp_code="s", sj_div="s", sj_nm="s", account_id="s", account_nm="s", thstrm_nm="s", thstrm_amount="s", thstrm_add_amount="s", frmtrm_nm="s", frmtrm_amount="s", frmtrm_add_amount="s", frmtrm_q_amount="s", currency="s", ord="s")
FILING = T.StructType([*schema(status="s", message="s"), T.StructField("list", T.ArrayType(FILING_LINE))])
