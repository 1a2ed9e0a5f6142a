"""Declared schemas of the input tables, as DDL."""

SCHEMAS = {
    "studies": (
        "nct_id string, study_type string, is_fda_regulated_drug boolean, is_fda_regulated_device boolean, "
        "is_unapproved_device boolean, overall_status string, enrollment bigint, start_date string, "
        "completion_date string, phase string, number_of_arms bigint, official_title string"
    ),
    "eligibilities": (
        "nct_id string, sampling_method string, gender string, minimum_age string, maximum_age string"
    ),
    "countries": "nct_id string, name string",
    "calculated_values": "nct_id string, were_results_reported boolean",
    "baseline_counts": "nct_id string, ctgov_group_code string, count bigint",
    "baseline_measurements": (
        "nct_id string, ctgov_group_code string, classification string, category string, title string, "
        "units string, param_type string, param_value_num double"
    ),
    "interventions": "nct_id string, intervention_type string, name string, description string",
    "sponsors": "nct_id string, agency_class string, lead_or_collaborator string",
    "browse_conditions": "nct_id string, mesh_term string",
    "brief_summaries": "nct_id string, description string",
    "design_groups": "nct_id string, title string, description string",
    "design_outcomes": "nct_id string, measure string, description string",
    "detailed_descriptions": "nct_id string, description string",
    "census": (
        "country string, year string, male double, female double, age_lt18 double, age_18_65 double, "
        "age_gt65 double, white double, hispanic double, black double, am_indian double, asian double, "
        "hawaiian double, mixed double"
    ),
    "keywords": "keyword string",
    "titles": "title string",
    "labels": "cat_title string, cat_exp string, piv_cat string",
    "code_map_1": "ICD10CM_ID string, MESH_ID string",
    "code_map_2": "ICD10CM_ID string, MESH_ID string",
    "mesh_icd": "label string, icd_code string, mesh_code string",
    "trial_icd": "NCT_id string, ICD10 string",
}

REGISTRY_TABLES = [
    "studies",
    "eligibilities",
    "countries",
    "calculated_values",
    "baseline_counts",
    "baseline_measurements",
    "interventions",
    "sponsors",
    "browse_conditions",
    "brief_summaries",
    "design_groups",
    "design_outcomes",
    "detailed_descriptions",
]
