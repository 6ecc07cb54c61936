"""The 23 enrichment views as declarative specs, and how to build them.

A ``ViewSpec`` says which fact table a view reads, how the fact reaches the
facility (crosswalk program, case bridge or its own ``REGISTRY_ID``), an
optional fact filter and the ordered output columns.  ``build_view`` turns a
spec into one DataFrame plan; ``plans.refresh`` materialises them.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins as J


@dataclass(frozen=True)
class ViewSpec:
    name: str                  # table name of the materialised view
    key: str                   # registered query name
    fact: str                  # fact table
    fact_key: str              # fact column that reaches the facility side
    columns: str               # "f.X, e.Y, c.Z" in output order
    program: str | None = None          # crosswalk PGM (J2/J3)
    bridge: str | None = None           # bridge table (J4/J5)
    bridge_key: str | None = None       # bridge column equal to fact_key
    fact_filter: tuple[str, str] | None = None  # (column, value) equality

    @property
    def shape(self) -> str:
        if self.program:
            return "crosswalk"
        if self.bridge:
            return "bridge"
        return "registry"

    def output(self) -> list[tuple[str, str]]:
        out = []
        for item in self.columns.split(","):
            side, name = item.strip().split(".")
            out.append((side, name))
        return out

    def side_columns(self, side: str) -> list[str]:
        return [n for s, n in self.output() if s == side]

    @property
    def tables(self) -> list[str]:
        t = [self.fact, "ECHO_EXPORTER"]
        if self.program:
            t.append("EXP_PGM")
        if self.bridge:
            t.append(self.bridge)
        return t


# The 23 views of the reference data model -- fact table, join
# path, filter and output columns in their published SELECT order.
# f = fact table, c = CASE_FACILITIES bridge, e = facility (ECHO_EXPORTER).
VIEWS: tuple[ViewSpec, ...] = (
    ViewSpec("AIR_COMPLIANCE_MVIEW", "mview_air_compliance", "ICIS-AIR_FCES_PCES", "PGM_SYS_ID",
             "f.PGM_SYS_ID, f.ACTIVITY_ID, f.STATE_EPA_FLAG, f.ACTIVITY_TYPE_CODE, f.ACTIVITY_TYPE_DESC, f.COMP_MONITOR_TYPE_CODE, f.COMP_MONITOR_TYPE_DESC, f.ACTUAL_END_DATE, f.PROGRAM_CODES, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="AIR_IDS"),
    ViewSpec("AIR_ENFORCEMENTS_MVIEW", "mview_air_enforcements", "CASE_ENFORCEMENTS", "CASE_NUMBER",
             "c.FACILITY_NAME, c.LOCATION_ADDRESS, c.CITY, c.ZIP, c.PRIMARY_SIC_CODE, c.PRIMARY_NAICS_CODE, f.ACTIVITY_ID, f.ACTIVITY_NAME, f.STATE_CODE, f.REGION_CODE, f.FISCAL_YEAR, f.CASE_NUMBER, f.CASE_NAME, f.ACTIVITY_TYPE_CODE, f.ACTIVITY_TYPE_DESC, f.ACTIVITY_STATUS_CODE, f.ACTIVITY_STATUS_DESC, f.ACTIVITY_STATUS_DATE, f.LEAD, f.CASE_STATUS_DATE, f.DOJ_DOCKET_NMBR, f.ENF_OUTCOME_CODE, f.ENF_OUTCOME_DESC, f.TOTAL_PENALTY_ASSESSED_AMT, f.TOTAL_COST_RECOVERY_AMT, f.TOTAL_COMP_ACTION_AMT, f.HQ_DIVISION, f.BRANCH, f.VOLUNTARY_SELF_DISCLOSURE_FLAG, f.MULTIMEDIA_FLAG, f.ENF_SUMMARY_TEXT, e.FAC_NAICS_CODES, e.FAC_DERIVED_HUC, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_SIC_CODES, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN",
             bridge="CASE_FACILITIES", bridge_key="CASE_NUMBER", fact_filter=("HQ_DIVISION", "AIR")),
    ViewSpec("AIR_FORMAL_ACTIONS_MVIEW", "mview_air_formal_actions", "ICIS-AIR_FORMAL_ACTIONS", "PGM_SYS_ID",
             "f.PGM_SYS_ID, f.ACTIVITY_ID, f.ENF_IDENTIFIER, f.ACTIVITY_TYPE_CODE, f.ACTIVITY_TYPE_DESC, f.STATE_EPA_FLAG, f.ENF_TYPE_CODE, f.ENF_TYPE_DESC, f.SETTLEMENT_ENTERED_DATE, f.PENALTY_AMOUNT, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="AIR_IDS"),
    ViewSpec("AIR_INSPECTIONS_MVIEW", "mview_air_inspections", "ICIS_FEC_EPA_INSPECTIONS", "REGISTRY_ID",
             "f.REGISTRY_ID, f.PGM_SYS_ACRNM, f.PGM_SYS_ID, f.FACILITY_NAME, f.EPA_REGION_CODE, f.ACTIVITY_ID, f.ACTIVITY_TYPE_CODE, f.ACTIVITY_TYPE_DESC, f.COMP_MONITOR_UID, f.COMP_MONITOR_TYPES, f.STATUTE_CODE, f.LAW_SECTION_CODE, f.ACTUAL_BEGIN_DATE, f.ACTUAL_END_DATE, f.AGENCY, f.COMP_MONITOR_AGENCY_TYPES, e.FAC_DERIVED_HUC, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_SIC_CODES, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_NAICS_CODES, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN"),
    ViewSpec("AIR_VIOLATIONS_MVIEW", "mview_air_violations", "ICIS-AIR_VIOLATION_HISTORY", "PGM_SYS_ID",
             "f.PGM_SYS_ID, f.ACTIVITY_ID, f.AGENCY_TYPE_DESC, f.STATE_CODE, f.AIR_LCON_CODE, f.COMP_DETERMINATION_UID, f.ENF_RESPONSE_POLICY_CODE, f.PROGRAM_CODES, f.PROGRAM_DESCS, f.POLLUTANT_CODES, f.POLLUTANT_DESCS, f.EARLIEST_FRV_DETERM_DATE, f.HPV_DAYZERO_DATE, f.HPV_RESOLVED_DATE, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="AIR_IDS"),
    ViewSpec("CASE_ENFORCEMENTS_MVIEW", "mview_case_enforcements", "CASE_ENFORCEMENTS", "ACTIVITY_ID",
             "f.ACTIVITY_ID, f.REGION_CODE, f.FISCAL_YEAR, f.ACTIVITY_TYPE_CODE, f.ACTIVITY_TYPE_DESC, f.ACTIVITY_STATUS_CODE, f.ACTIVITY_STATUS_DESC, f.ACTIVITY_STATUS_DATE, f.LEAD, f.CASE_STATUS_DATE, f.ENF_OUTCOME_CODE, f.ENF_OUTCOME_DESC, f.TOTAL_PENALTY_ASSESSED_AMT, f.TOTAL_COST_RECOVERY_AMT, f.TOTAL_COMP_ACTION_AMT, f.VOLUNTARY_SELF_DISCLOSURE_FLAG, f.ENF_SUMMARY_TEXT, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             bridge="CASE_FACILITIES", bridge_key="ACTIVITY_ID"),
    ViewSpec("CLEAN_WATER_ENFORCEMENT_ACTIONS_MVIEW", "mview_clean_water_enforcement_actions", "NPDES_FORMAL_ENFORCEMENT_ACTIONS", "NPDES_ID",
             "f.NPDES_ID, f.ENF_IDENTIFIER, f.ACTIVITY_ID, f.ACTIVITY_TYPE_CODE, f.ENF_TYPE_CODE, f.ENF_TYPE_DESC, f.AGENCY, f.SETTLEMENT_ENTERED_DATE, f.FED_PENALTY_ASSESSED_AMT, f.STATE_LOCAL_PENALTY_AMT, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
    ViewSpec("CLEAN_WATER_INSPECTIONS_MVIEW", "mview_clean_water_inspections", "NPDES_INSPECTIONS", "NPDES_ID",
             "f.REGISTRY_ID, f.NPDES_ID, f.ACTIVITY_ID, f.ACTIVITY_TYPE_CODE, f.COMP_MONITOR_TYPE_CODE, f.COMP_MONITOR_TYPE_DESC, f.STATE_EPA_FLAG, f.ACTUAL_BEGIN_DATE, f.ACTUAL_END_DATE, f.ACTIVITY_OUTCOME_CODE, f.ACTIVITY_OUTCOME_DESC, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
    ViewSpec("COMBINED_AIR_EMISSIONS_MVIEW", "mview_combined_air_emissions", "POLL_RPT_COMBINED_EMISSIONS", "REGISTRY_ID",
             "f.REPORTING_YEAR, f.REGISTRY_ID, f.PGM_SYS_ACRNM, f.PGM_SYS_ID, f.POLLUTANT_NAME, f.ANNUAL_EMISSION, f.UNIT_OF_MEASURE, f.NEI_TYPE, f.NEI_HAP_VOC_FLAG, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL"),
    ViewSpec("DMR_FY2020_MVIEW", "mview_dmr_fy2020", "NPDES_DMRS_FY2020", "EXTERNAL_PERMIT_NMBR",
             "f.ACTIVITY_ID, f.DMR_EVENT_ID, f.DMR_SAMPLE_TYPE_CODE, f.DMR_UNIT_CODE, f.DMR_UNIT_DESC, f.DMR_VALUE_ID, f.DMR_VALUE_NMBR, f.DMR_VALUE_QUALIFIER_CODE, f.DMR_VALUE_STANDARD_UNITS, f.EXCEEDENCE_PCT, f.LIMIT_BEGIN_DATE, f.LIMIT_END_DATE, f.LIMIT_UNIT_CODE, f.LIMIT_UNIT_DESC, f.LIMIT_VALUE_ID, f.LIMIT_VALUE_NMBR, f.LIMIT_VALUE_QUALIFIER_CODE, f.LIMIT_VALUE_STANDARD_UNITS, f.LIMIT_VALUE_TYPE_CODE, f.MONITORING_LOCATION_CODE, f.NODI_CODE, f.PARAMETER_CODE, f.PARAMETER_DESC, f.STANDARD_UNIT_CODE, f.STANDARD_UNIT_DESC, f.VIOLATION_CODE, f.EXTERNAL_PERMIT_NMBR, f.MONITORING_PERIOD_END_DATE, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
    ViewSpec("DMR_FY2022_MVIEW", "mview_dmr_fy2022", "NPDES_DMRS_FY2022", "EXTERNAL_PERMIT_NMBR",
             "f.ACTIVITY_ID, f.DMR_EVENT_ID, f.DMR_SAMPLE_TYPE_CODE, f.DMR_UNIT_CODE, f.DMR_UNIT_DESC, f.DMR_VALUE_ID, f.DMR_VALUE_NMBR, f.DMR_VALUE_QUALIFIER_CODE, f.DMR_VALUE_STANDARD_UNITS, f.EXCEEDENCE_PCT, f.LIMIT_BEGIN_DATE, f.LIMIT_END_DATE, f.LIMIT_UNIT_CODE, f.LIMIT_UNIT_DESC, f.LIMIT_VALUE_ID, f.LIMIT_VALUE_NMBR, f.LIMIT_VALUE_QUALIFIER_CODE, f.LIMIT_VALUE_STANDARD_UNITS, f.LIMIT_VALUE_TYPE_CODE, f.MONITORING_LOCATION_CODE, f.NODI_CODE, f.PARAMETER_CODE, f.PARAMETER_DESC, f.STANDARD_UNIT_CODE, f.STANDARD_UNIT_DESC, f.VIOLATION_CODE, f.EXTERNAL_PERMIT_NMBR, f.MONITORING_PERIOD_END_DATE, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
    ViewSpec("EFF_VIOLATIONS_MVIEW", "mview_eff_violations", "NPDES_EFF_VIOLATIONS", "NPDES_ID",
             "f.NPDES_ID, f.MONITORING_PERIOD_END_DATE, f.RNC_DETECTION_CODE, f.RNC_DETECTION_DESC, f.RNC_RESOLUTION_CODE, f.RNC_RESOLUTION_DESC, f.VIOLATION_CODE, f.VIOLATION_DESC, f.PARAMETER_DESC, f.DMR_VALUE_NMBR, f.EXCEEDENCE_PCT, f.DMR_VALUE_STANDARD_UNITS, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
    ViewSpec("GREENHOUSE_GASES_MVIEW", "mview_greenhouse_gases", "POLL_RPT_COMBINED_EMISSIONS", "REGISTRY_ID",
             "f.REPORTING_YEAR, f.REGISTRY_ID, f.PGM_SYS_ACRNM, f.PGM_SYS_ID, f.POLLUTANT_NAME, f.ANNUAL_EMISSION, f.UNIT_OF_MEASURE, f.NEI_TYPE, f.NEI_HAP_VOC_FLAG, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             fact_filter=("PGM_SYS_ACRNM", "E-GGRT")),
    ViewSpec("RCRA_ENFORCEMENTS_MVIEW", "mview_rcra_enforcements", "RCRA_ENFORCEMENTS", "ID_NUMBER",
             "f.ID_NUMBER, f.ACTIVITY_LOCATION, f.ENFORCEMENT_IDENTIFIER, f.ENFORCEMENT_TYPE, f.ENFORCEMENT_DESC, f.ENFORCEMENT_AGENCY, f.ENFORCEMENT_ACTION_DATE, f.PMP_AMOUNT, f.FMP_AMOUNT, f.FSC_AMOUNT, f.SCR_AMOUNT, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_NAICS_CODES, e.FAC_DERIVED_WBD, e.FAC_SIC_CODES, e.FAC_DERIVED_HUC, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN",
             program="RCRA_IDS"),
    ViewSpec("RCRA_EVALUATIONS_MVIEW", "mview_rcra_evaluations", "RCRA_EVALUATIONS", "ID_NUMBER",
             "f.ID_NUMBER, f.ACTIVITY_LOCATION, f.EVALUATION_IDENTIFIER, f.EVALUATION_TYPE, f.EVALUATION_DESC, f.EVALUATION_AGENCY, f.EVALUATION_START_DATE, f.FOUND_VIOLATION, e.FAC_DERIVED_HUC, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_NAICS_CODES, e.FAC_SIC_CODES, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN",
             program="RCRA_IDS"),
    ViewSpec("RCRA_VIOLATIONS_MVIEW", "mview_rcra_violations", "RCRA_VIOLATIONS", "ID_NUMBER",
             "f.ID_NUMBER, f.ACTIVITY_LOCATION, f.VIOLATION_TYPE, f.VIOLATION_TYPE_DESC, f.VIOL_DETERMINED_BY_AGENCY, f.DATE_VIOLATION_DETERMINED, f.ACTUAL_RTC_DATE, f.SCHEDULED_COMPLIANCE_DATE, e.FAC_DERIVED_HUC, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_SIC_CODES, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_NAICS_CODES, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN",
             program="RCRA_IDS"),
    ViewSpec("SDWA_ENFORCEMENTS_MVIEW", "mview_sdwa_enforcements", "SDWA_ENFORCEMENTS", "PWSID",
             "f.PWSID, f.PWS_NAME, f.CITY_SERVED, f.STATE, f.STATE_NAME, f.PWS_TYPE_CODE, f.PWS_TYPE_SHORT, f.SOURCE_WATER, f.PWS_SIZE, f.POPULATION_SERVED_COUNT, f.FISCAL_YEAR, f.ENFORCEMENT_DATE, f.ENFORCEMENT_CATEGORY, f.DESCRIPTION, f.AGENCY, f.ENFORCEMENT_ID, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="SDWA_IDS"),
    ViewSpec("SDWA_PUBLIC_WATER_SYSTEMS_MVIEW", "mview_sdwa_public_water_systems", "SDWA_PUB_WATER_SYSTEMS", "PWSID",
             "f.PWSID, f.FISCAL_YEAR, f.STATE, f.STATE_NAME, f.EPA_REGION, f.PWS_TYPE_CODE, f.PWS_NAME, f.CITY_SERVED, f.STATE_CODE, f.SOURCE_WATER, f.IS_TRIBAL, f.SYSTEM_SIZE, f.POPULATION_SERVED_COUNT, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="SDWA_IDS"),
    ViewSpec("SDWA_SERIOUS_VIOLATORS_MVIEW", "mview_sdwa_serious_violators", "SDWA_SERIOUS_VIOLATORS", "PWSID",
             "f.PWSID, f.PWS_NAME, f.CITY_SERVED, f.STATE, f.STATE_NAME, f.PWS_TYPE_CODE, f.PWS_TYPE_SHORT, f.SOURCE_WATER, f.PWS_SIZE, f.POPULATION_SERVED_COUNT, f.FISCAL_YEAR, f.SERIOUS_VIOLATOR, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="SDWA_IDS"),
    ViewSpec("SDWA_SITE_VISITS_MVIEW", "mview_sdwa_site_visits", "SDWA_SITE_VISITS", "PWSID",
             "f.PWSID, f.PWS_NAME, f.CITY_SERVED, f.STATE, f.STATE_NAME, f.PWS_TYPE_CODE, f.PWS_TYPE_SHORT, f.SOURCE_WATER, f.PWS_SIZE, f.POPULATION_SERVED_COUNT, f.FISCAL_YEAR, f.SITE_VISIT_DATE, f.SANITARY_SURVEY, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="SDWA_IDS"),
    ViewSpec("SDWA_VIOLATIONS_MVIEW", "mview_sdwa_violations", "SDWA_VIOLATIONS", "PWSID",
             "f.PWSID, f.PWS_NAME, f.CITY_SERVED, f.STATE, f.STATE_NAME, f.PWS_TYPE_CODE, f.PWS_TYPE_SHORT, f.SOURCE_WATER, f.PWS_SIZE, f.POPULATION_SERVED_COUNT, f.FISCAL_YEAR, f.VIOLATION_NAME, f.VIOLATION_ID, f.RULE_NAME, f.BEGIN_YEAR, f.END_YEAR, f.RTC_YEAR, f.ACUTE_HEALTH_BASED, f.HEALTH_BASED, f.MONITORING_REPORTING, f.PUBLIC_NOTIF_OTHER, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="SDWA_IDS"),
    ViewSpec("TOXIC_RELEASES_MVIEW", "mview_toxic_releases", "POLL_RPT_COMBINED_EMISSIONS", "REGISTRY_ID",
             "f.REPORTING_YEAR, f.REGISTRY_ID, f.PGM_SYS_ACRNM, f.PGM_SYS_ID, f.POLLUTANT_NAME, f.ANNUAL_EMISSION, f.UNIT_OF_MEASURE, f.NEI_TYPE, f.NEI_HAP_VOC_FLAG, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             fact_filter=("PGM_SYS_ACRNM", "TRIS")),
    ViewSpec("WATER_QUARTERLY_VIOLATIONS_MVIEW", "mview_water_quarterly_violations", "NPDES_QNCR_HISTORY", "NPDES_ID",
             "f.NPDES_ID, f.YEARQTR, f.HLRNC, f.NUME90Q, f.NUMCVDT, f.NUMSVCD, f.NUMPSCH, e.REGISTRY_ID, e.FAC_NAME, e.FAC_STREET, e.FAC_CITY, e.FAC_STATE, e.FAC_ZIP, e.FAC_COUNTY, e.FAC_EPA_REGION, e.FAC_LAT, e.FAC_LONG, e.FAC_DERIVED_WBD, e.FAC_DERIVED_CD113, e.FAC_PERCENT_MINORITY, e.FAC_POP_DEN, e.FAC_DERIVED_HUC, e.FAC_SIC_CODES, e.FAC_NAICS_CODES, e.DFR_URL",
             program="NPDES_IDS"),
)

VIEWS_BY_NAME = {v.name: v for v in VIEWS}
VIEWS_BY_KEY = {v.key: v for v in VIEWS}


def derivable_from(spec: ViewSpec, base: ViewSpec) -> bool:
    """True when ``spec`` is ``base`` plus one equality filter on a column
    ``base`` outputs: same fact, same join path, same columns, base unfiltered.
    Such a view is a filter of the stored base view -- no second join."""
    if spec is base or base.fact_filter is not None or spec.fact_filter is None:
        return False
    same_path = (spec.fact, spec.fact_key, spec.program, spec.bridge, spec.bridge_key) == \
                (base.fact, base.fact_key, base.program, base.bridge, base.bridge_key)
    return same_path and spec.output() == base.output() and ("f", spec.fact_filter[0]) in base.output()


def facility_columns_used(specs=VIEWS) -> list[str]:
    """Union of facility columns over the specs (for the shared dimension)."""
    seen: list[str] = []
    for spec in specs:
        for c in spec.side_columns("e"):
            if c not in seen:
                seen.append(c)
    return seen


def view_dimension(spec: ViewSpec, tables: Mapping[str, DataFrame],
                   shared_dim: DataFrame | None = None) -> DataFrame:
    """The facility-side relation of a view, keyed by ``k__``."""
    fac = tables["ECHO_EXPORTER"]
    e_cols = spec.side_columns("e")
    if spec.shape == "crosswalk":
        if shared_dim is not None:
            return (shared_dim.where(F.col("PGM") == F.lit(spec.program))
                    .select(J.KEY, *[J.side_name("e", c) for c in e_cols]))
        return J.program_dimension(tables["EXP_PGM"], fac, spec.program, e_cols)
    if spec.shape == "bridge":
        return J.bridge_dimension(tables[spec.bridge], spec.bridge_key, spec.side_columns("c"),
                                  fac, e_cols)
    return J.registry_dimension(fac, e_cols)


def _linked_keys(spec: ViewSpec, tables: Mapping[str, DataFrame], shared_dim: DataFrame | None) -> DataFrame:
    """The ids of a crosswalk view's program (``k__``): facts with other ids join nothing."""
    ids, name = (tables["EXP_PGM"], "PGM_ID") if shared_dim is None else (shared_dim, J.KEY)
    return ids.where(F.col("PGM") == F.lit(spec.program)).select(F.col(name).alias(J.KEY))


def build_view(spec: ViewSpec, tables: Mapping[str, DataFrame], skew: str = "aqe",
               shared_dim: DataFrame | None = None, broadcast_dim: bool = False,
               **salt_opts) -> DataFrame:
    """One DataFrame plan for a view: fact (filtered, pruned) joined once to
    its dimension, columns in the published order.

    ``broadcast_dim`` is set by callers that measured the dimension (a stored
    partition) and found it under the broadcast limit; otherwise Spark picks
    the join from its statistics and AQE re-plans it from runtime sizes.  Then the
    facts of a crosswalk view whose id the program does not list are left out before
    the shuffle (``joins.linked_rows``, unless the session switches broadcasts off), and both sides are shuffled with their texts in
    one column (``joins.packed_texts``).
    """
    f_cols = spec.side_columns("f")
    fact = tables[spec.fact]
    if spec.fact_filter:
        col, val = spec.fact_filter
        fact = fact.where(F.col(col) == F.lit(val))
    needed = list(dict.fromkeys([spec.fact_key, *f_cols]))
    fact = fact.select(*needed)
    dim = view_dimension(spec, tables, shared_dim)
    if broadcast_dim:
        dim = F.broadcast(dim)
    elif spec.shape == "crosswalk" and skew != "salt" and not J.is_bucketed(dim) and J.may_broadcast(fact):   # the salt wants the fact as it is stored
        fact = J.linked_rows(fact, spec.fact_key, _linked_keys(spec, tables, shared_dim))
    texts = {}
    if not broadcast_dim and skew != "salt":
        fact, texts = J.packed_texts(fact, spec.fact_key, "texts__f")
        if not J.is_bucketed(dim):                          # a bucketed one is not shuffled
            dim, own = J.packed_texts(dim, J.KEY, "texts__d")
            texts |= own
    joined = J.join_to_dimension(fact, spec.fact_key, dim, skew=skew, **salt_opts)
    sides = [(n, n if s == "f" else J.side_name(s, n)) for s, n in spec.output()]
    return joined.select(*[texts.get(name, F.col(name)).alias(n) for n, name in sides])


def sql_text(spec: ViewSpec, table=lambda name: name.replace("-", "_")) -> str:
    """The spec as one SQL statement; ``table`` gives each table's name there (by
    default the SQL-safe one, ``-`` -> ``_``)."""
    side = {"f": "fact", "e": "facility", "c": "bridge"}
    facility = f"JOIN {table('ECHO_EXPORTER')} facility ON facility.REGISTRY_ID = "
    if spec.shape == "crosswalk":
        joins = (f"JOIN {table('EXP_PGM')} link ON link.PGM_ID = fact.{spec.fact_key} AND link.PGM = '{spec.program}' "
                 f"{facility}link.REGISTRY_ID")
    elif spec.shape == "bridge":
        joins = f"JOIN {table(spec.bridge)} bridge ON bridge.{spec.bridge_key} = fact.{spec.fact_key} {facility}bridge.REGISTRY_ID"
    else:
        joins = f"{facility}fact.REGISTRY_ID"
    columns = ", ".join(f"{side[s]}.{n}" for s, n in spec.output())
    only = f" WHERE fact.{spec.fact_filter[0]} = '{spec.fact_filter[1]}'" if spec.fact_filter else ""
    return f"SELECT {columns} FROM {table(spec.fact)} fact {joins}{only}"
