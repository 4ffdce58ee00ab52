"""Table schemas of the star organisation -> programme -> call -> result, and versioned evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ORGANIZATIONS = "id string, name string, name_en string, type string, foundation_subtype string, legal_form string, corporate_parent string, parent_company_id string, prefecture string, municipality string, url string, description string, contact_phone string, contact_email string, contact_address string, established_year int, koeki_id string, koeki_certified_date string, founder_name string, country_code string, total_assets long, annual_grant_amount long, annual_grant_year string, annual_grant_amount_history string, jfc_rank int, primary_field string, primary_field_method string, research_relevance string, admin_agency string, koeki_verified int, koeki_matched_name string, source_dataset string, needs_program_verification int, ingested_at string, duplicate_of string, annual_grant_fy int, annual_grant_is_estimate int, metadata string, created_at string, updated_at string"
_PROGRAMS = "id string, organization_id string, name string, description string, purpose string, category string, subcategories string, total_budget long, is_recurring int, source_url string, metadata string, amount_per_award long, num_awards_per_year int, program_total_budget long, amount_source_url string, created_at string, updated_at string"
_CALLS = "id string, program_id string, fiscal_year int, round_number int, title string, status string, application_start string, application_deadline string, grant_period_start string, grant_period_end string, grant_amount_min long, grant_amount_max long, grant_rate double, expected_awards int, actual_awards int, source_url string, guideline_url string, summary string, target_area string, target_industries string, keywords string, metadata string, created_at string, updated_at string"
_RESULTS = "id string, call_id string, fiscal_year int, awardee_name string, awardee_kana string, awardee_type string, awardee_affiliation string, awardee_position string, awardee_department string, project_title string, project_abstract string, award_amount long, award_period_start string, award_period_end string, field_category_id string, keywords string, source_url string, metadata string, grant_type string, rid_base_id long, rid_field string, rid_affiliation_match int, source_dataset string, created_at string, updated_at string"

#: Name -> schema.  Columns that a later version adds stand at the end of ``ADDED``.
TABLES: dict[str, str] = {
    "organizations": _ORGANIZATIONS,
    "grant_programs": _PROGRAMS,
    "grant_calls": _CALLS,
    "grant_results": _RESULTS,
    "eligibility_criteria": "id string, call_id string, criterion_type string, description string, is_required int, source_url string, source_dataset string, metadata string, created_at string",
    "parent_companies": "id string, name string, name_short string, name_en string, ticker string, exchange string, group_name string, industry string, headquarters_country string, headquarters_pref string, founded_year int, url string, description string, metadata string",
    "foundation_categories": "id string, parent_id string, level int, name_ja string, name_en string, description string, sort_order int, created_at string",
    "foundation_focus_areas": "organization_id string, category_id string, weight double, is_primary int, evidence string, source string, created_at string",
    "grant_amounts": "id string, organization_id string, foundation_name string, program_name string, amount_per_award long, amount_type string, num_awards_per_year int, total_budget long, fiscal_year int, target_field string, source_url string, source_dataset string, created_at string",
    "foundation_officers": "id string, organization_id string, role string, role_ja string, person_name string, affiliation string, title string, is_corporate_exec int, corporate_name string, fiscal_year int, source_url string, source_dataset string, metadata string, created_at string, rid_base_id long, rid_field string",
    "cross_db_mapping": "cfg_id string, grant_db_id string, match_method string, match_confidence double, cfg_name string, grant_db_name string, notes string, created_at string",
    "integration_metadata": "id string, operation string, cfg_count int, grant_db_count int, matched_count int, unmatched_cfg int, unmatched_gdb int, duration_ms int, notes string, started_at string, completed_at string",
    "schema_migrations": "version string, description string, applied_at string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def ensure_columns(df: DataFrame, name: str) -> DataFrame:
    """The table's columns in order, missing ones as typed NULLs; unknown columns follow."""
    want = schema(name)
    have = set(df.columns)
    known = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in want]
    return df.select(*known, *[c for c in df.columns if c not in want.names])
