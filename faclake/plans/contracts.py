"""Declared schemas of the base tables the enrichment views read.

Fixed values: column names, order and Spark types of the published data files
(names upper-cased, every column nullable).  They are the input contract of
the views; ingest takes its schemas from the schema documents at run time, and
these strings are used to check a lake and to shape test inputs.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Base-table schemas (DDL, file column order).
BASE_TABLE_DDL = {
    "CASE_ENFORCEMENTS": "ACTIVITY_ID long, ACTIVITY_NAME string, STATE_CODE string, REGION_CODE string, FISCAL_YEAR double, CASE_NUMBER string, CASE_NAME string, ACTIVITY_TYPE_CODE string, ACTIVITY_TYPE_DESC string, ACTIVITY_STATUS_CODE string, ACTIVITY_STATUS_DESC string, ACTIVITY_STATUS_DATE string, LEAD string, CASE_STATUS_DATE string, DOJ_DOCKET_NMBR string, ENF_OUTCOME_CODE string, ENF_OUTCOME_DESC string, TOTAL_PENALTY_ASSESSED_AMT double, TOTAL_COST_RECOVERY_AMT double, TOTAL_COMP_ACTION_AMT double, HQ_DIVISION string, BRANCH string, VOLUNTARY_SELF_DISCLOSURE_FLAG string, MULTIMEDIA_FLAG string, ENF_SUMMARY_TEXT string",
    "CASE_FACILITIES": "ACTIVITY_ID long, CASE_NUMBER string, REGISTRY_ID string, FACILITY_NAME string, LOCATION_ADDRESS string, CITY string, STATE_CODE string, ZIP string, PRIMARY_SIC_CODE string, PRIMARY_NAICS_CODE string",
    "ICIS-AIR_FCES_PCES": "PGM_SYS_ID string, ACTIVITY_ID long, STATE_EPA_FLAG string, ACTIVITY_TYPE_CODE string, ACTIVITY_TYPE_DESC string, COMP_MONITOR_TYPE_CODE string, COMP_MONITOR_TYPE_DESC string, ACTUAL_END_DATE string, PROGRAM_CODES string, ACTIVITY_PURPOSE_DESC string",
    "ICIS-AIR_FORMAL_ACTIONS": "PGM_SYS_ID string, ACTIVITY_ID long, ENF_IDENTIFIER string, ACTIVITY_TYPE_CODE string, ACTIVITY_TYPE_DESC string, STATE_EPA_FLAG string, ENF_TYPE_CODE string, ENF_TYPE_DESC string, SETTLEMENT_ENTERED_DATE string, PENALTY_AMOUNT double",
    "ICIS-AIR_VIOLATION_HISTORY": "PGM_SYS_ID string, ACTIVITY_ID long, AGENCY_TYPE_DESC string, STATE_CODE string, AIR_LCON_CODE string, COMP_DETERMINATION_UID string, ENF_RESPONSE_POLICY_CODE string, PROGRAM_CODES string, PROGRAM_DESCS string, POLLUTANT_CODES string, POLLUTANT_DESCS string, EARLIEST_FRV_DETERM_DATE string, HPV_DAYZERO_DATE string, HPV_RESOLVED_DATE string, DSCV_PATHWAY_DATE string, NFTC_PATHWAY_DATE string",
    "ICIS_FEC_EPA_INSPECTIONS": "REGISTRY_ID string, PGM_SYS_ACRNM string, PGM_SYS_ID string, FACILITY_NAME string, EPA_REGION_CODE string, ACTIVITY_ID long, ACTIVITY_TYPE_CODE string, ACTIVITY_TYPE_DESC string, COMP_MONITOR_UID string, COMP_MONITOR_TYPES string, STATUTE_CODE string, LAW_SECTION_CODE string, ACTUAL_BEGIN_DATE string, ACTUAL_END_DATE string, AGENCY string, COMP_MONITOR_AGENCY_TYPES string",
    "NPDES_DMRS_FY2020": "ACTIVITY_ID long, EXTERNAL_PERMIT_NMBR string, VERSION_NMBR double, PERM_FEATURE_ID long, PERM_FEATURE_NMBR string, PERM_FEATURE_TYPE_CODE string, LIMIT_SET_ID long, LIMIT_SET_DESIGNATOR string, LIMIT_SET_SCHEDULE_ID long, LIMIT_ID long, LIMIT_BEGIN_DATE string, LIMIT_END_DATE string, NMBR_OF_SUBMISSION double, NMBR_OF_REPORT double, PARAMETER_CODE string, PARAMETER_DESC string, MONITORING_LOCATION_CODE string, STAY_TYPE_CODE string, LIMIT_VALUE_ID long, LIMIT_VALUE_TYPE_CODE string, LIMIT_VALUE_NMBR double, LIMIT_UNIT_CODE string, LIMIT_UNIT_DESC string, STANDARD_UNIT_CODE string, STANDARD_UNIT_DESC string, LIMIT_VALUE_STANDARD_UNITS double, STATISTICAL_BASE_CODE string, STATISTICAL_BASE_TYPE_CODE string, LIMIT_VALUE_QUALIFIER_CODE string, OPTIONAL_MONITORING_FLAG string, LIMIT_SAMPLE_TYPE_CODE string, LIMIT_FREQ_OF_ANALYSIS_CODE string, STAY_VALUE_NMBR double, LIMIT_TYPE_CODE string, DMR_EVENT_ID long, MONITORING_PERIOD_END_DATE string, DMR_SAMPLE_TYPE_CODE string, DMR_FREQ_OF_ANALYSIS_CODE string, REPORTED_EXCURSION_NMBR double, DMR_FORM_VALUE_ID long, VALUE_TYPE_CODE string, DMR_VALUE_ID long, DMR_VALUE_NMBR double, DMR_UNIT_CODE string, DMR_UNIT_DESC string, DMR_VALUE_STANDARD_UNITS double, DMR_VALUE_QUALIFIER_CODE string, VALUE_RECEIVED_DATE string, DAYS_LATE double, NODI_CODE string, EXCEEDENCE_PCT double, NPDES_VIOLATION_ID long, VIOLATION_CODE string, RNC_DETECTION_CODE string, RNC_DETECTION_DATE string, RNC_RESOLUTION_CODE string, RNC_RESOLUTION_DATE string",
    "NPDES_EFF_VIOLATIONS": "NPDES_ID string, VERSION_NMBR double, ACTIVITY_ID long, NPDES_VIOLATION_ID long, PERM_FEATURE_NMBR string, PERMIT_ACTIVITY_ID long, LIMIT_SET_DESIGNATOR string, MONITORING_LOCATION_CODE string, DMR_FORM_VALUE_ID long, DMR_VALUE_NMBR double, DMR_VALUE_ID long, DMR_PARAMETER_ID long, NODI_CODE string, ADJUSTED_DMR_VALUE_NMBR double, LIMIT_VALUE_STANDARD_UNITS double, VIOLATION_TYPE_CODE string, VIOLATION_TYPE_DESC string, VIOLATION_CODE string, VIOLATION_DESC string, PARAMETER_CODE string, PARAMETER_DESC string, STANDARD_UNIT_CODE string, STANDARD_UNIT_DESC string, MONITORING_PERIOD_END_DATE string, NMBR_OF_REPORT double, EXCEEDENCE_PCT double, VALUE_QUALIFIER_CODE string, UNIT_CODE string, VALUE_RECEIVED_DATE string, DAYS_LATE double, ADJUSTED_DMR_STANDARD_UNITS double, LIMIT_ID long, DMR_VALUE_STANDARD_UNITS double, VALUE_TYPE_CODE string, RNC_DETECTION_CODE string, RNC_DETECTION_DESC string, RNC_DETECTION_DATE string, RNC_RESOLUTION_CODE string, RNC_RESOLUTION_DESC string, RNC_RESOLUTION_DATE string, STATISTICAL_BASE_CODE string, STATISTICAL_BASE_MONTHLY_AVG string, STATISTICAL_BASE_SHORT_DESC string",
    "NPDES_FORMAL_ENFORCEMENT_ACTIONS": "NPDES_ID string, ENF_IDENTIFIER string, ACTIVITY_ID long, ACTIVITY_TYPE_CODE string, ENF_TYPE_CODE string, ENF_TYPE_DESC string, AGENCY string, SETTLEMENT_ENTERED_DATE string, FED_PENALTY_ASSESSED_AMT double, STATE_LOCAL_PENALTY_AMT double",
    "NPDES_INSPECTIONS": "REGISTRY_ID string, NPDES_ID string, ACTIVITY_ID long, ACTIVITY_TYPE_CODE string, COMP_MONITOR_TYPE_CODE string, COMP_MONITOR_TYPE_DESC string, STATE_EPA_FLAG string, ACTUAL_BEGIN_DATE string, ACTUAL_END_DATE string, ACTIVITY_OUTCOME_CODE double, ACTIVITY_OUTCOME_DESC string",
    "NPDES_QNCR_HISTORY": "NPDES_ID string, YEARQTR string, HLRNC string, NUME90Q double, NUMCVDT double, NUMSVCD double, NUMPSCH double, NUMD8090Q double",
    "POLL_RPT_COMBINED_EMISSIONS": "REPORTING_YEAR long, REGISTRY_ID string, PGM_SYS_ACRNM string, PGM_SYS_ID string, POLLUTANT_NAME string, ANNUAL_EMISSION double, UNIT_OF_MEASURE string, NEI_TYPE string, NEI_HAP_VOC_FLAG string",
    "RCRA_ENFORCEMENTS": "ID_NUMBER string, ACTIVITY_LOCATION string, ENFORCEMENT_IDENTIFIER string, ENFORCEMENT_TYPE string, ENFORCEMENT_DESC string, ENFORCEMENT_AGENCY string, ENFORCEMENT_ACTION_DATE string, PMP_AMOUNT double, FMP_AMOUNT double, FSC_AMOUNT double, SCR_AMOUNT double",
    "RCRA_EVALUATIONS": "ID_NUMBER string, ACTIVITY_LOCATION string, EVALUATION_IDENTIFIER string, EVALUATION_TYPE string, EVALUATION_DESC string, EVALUATION_AGENCY string, EVALUATION_START_DATE string, FOUND_VIOLATION string",
    "RCRA_VIOLATIONS": "ID_NUMBER string, ACTIVITY_LOCATION string, VIOLATION_TYPE string, VIOLATION_TYPE_DESC string, VIOL_DETERMINED_BY_AGENCY string, DATE_VIOLATION_DETERMINED string, ACTUAL_RTC_DATE string, SCHEDULED_COMPLIANCE_DATE string",
    "SDWA_ENFORCEMENTS": "PWSID string, PWS_NAME string, CITY_SERVED string, STATE string, STATE_NAME string, PWS_TYPE_CODE string, PWS_TYPE_SHORT string, SOURCE_WATER string, PWS_SIZE string, POPULATION_SERVED_COUNT double, FISCAL_YEAR double, ENFORCEMENT_ID string, ENFORCEMENT_DATE string, ENFORCEMENT_CATEGORY string, DESCRIPTION string, AGENCY string",
    "SDWA_PUB_WATER_SYSTEMS": "PWSID string, FISCAL_YEAR long, STATE string, STATE_NAME string, EPA_REGION string, PWS_TYPE_CODE string, PWS_NAME string, CITY_SERVED string, STATE_CODE string, SOURCE_WATER string, IS_TRIBAL string, SYSTEM_SIZE string, POPULATION_SERVED_COUNT long",
    "SDWA_SERIOUS_VIOLATORS": "PWSID string, PWS_NAME string, CITY_SERVED string, STATE string, STATE_NAME string, PWS_TYPE_CODE string, PWS_TYPE_SHORT string, SOURCE_WATER string, PWS_SIZE string, POPULATION_SERVED_COUNT double, FISCAL_YEAR double, SERIOUS_VIOLATOR string",
    "SDWA_SITE_VISITS": "PWSID string, PWS_NAME string, CITY_SERVED string, STATE string, STATE_NAME string, PWS_TYPE_CODE string, PWS_TYPE_SHORT string, SOURCE_WATER string, PWS_SIZE string, POPULATION_SERVED_COUNT double, FISCAL_YEAR double, SITE_VISIT_DATE string, SANITARY_SURVEY string",
    "SDWA_VIOLATIONS": "PWSID string, PWS_NAME string, CITY_SERVED string, STATE string, STATE_NAME string, PWS_TYPE_CODE string, PWS_TYPE_SHORT string, SOURCE_WATER string, PWS_SIZE string, POPULATION_SERVED_COUNT double, FISCAL_YEAR double, VIOLATION_NAME string, VIOLATION_ID string, RULE_NAME string, BEGIN_YEAR double, END_YEAR double, RTC_YEAR double, ACUTE_HEALTH_BASED string, HEALTH_BASED string, MONITORING_REPORTING string, PUBLIC_NOTIF_OTHER string",
    # The facility table, cut to the columns the crosswalk and the views use
    # (the published file has 134 columns; ingest keeps all of them).
    "ECHO_EXPORTER": "REGISTRY_ID string, FAC_NAME string, FAC_STREET string, FAC_CITY string, FAC_STATE string, FAC_ZIP string, FAC_COUNTY string, FAC_EPA_REGION string, FAC_LAT double, FAC_LONG double, FAC_DERIVED_HUC string, FAC_DERIVED_WBD string, FAC_DERIVED_CD113 string, FAC_PERCENT_MINORITY double, FAC_POP_DEN double, AIR_FLAG string, NPDES_FLAG string, SDWIS_FLAG string, RCRA_FLAG string, AIR_IDS string, NPDES_IDS string, RCRA_IDS string, SDWA_IDS string, DFR_URL string, FAC_SIC_CODES string, FAC_NAICS_CODES string",
    "EXP_PGM": "PGM string, REGISTRY_ID string, PGM_ID string",
}

# Two data files share one schema document.
BASE_TABLE_DDL["NPDES_DMRS_FY2022"] = BASE_TABLE_DDL["NPDES_DMRS_FY2020"]


def ddl_fields(ddl: str) -> list[tuple[str, str]]:
    """``"A long, B string"`` -> ``[("A", "long"), ("B", "string")]``."""
    out = []
    for piece in ddl.split(","):
        name, typ = piece.strip().split(" ")
        out.append((name, typ))
    return out


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(BASE_TABLE_DDL[name])


def column_type(table: str, column: str) -> str:
    for name, typ in ddl_fields(BASE_TABLE_DDL[table]):
        if name == column:
            return typ
    raise KeyError(f"{table}.{column}")
