"""The driver queries once more in DuckDB's SQL, over the same tables, to check results against.

The input tables and steps are named CTEs; a query lists those it builds on.
"""

from __future__ import annotations

import re

from trialcohort.functions.fixed_values import (
    CATEGORY_LABELS,
    ENROLLMENT_GROUPS,
    ICD10_CHAPTERS,
    PIVOT_COLUMNS,
    PROMPT_SUFFIX,
    PROMPT_TEMPLATE,
    REQUEST_MODEL,
    SEARCHED_COLUMNS,
)
from trialcohort.functions.text import clean_keywords
from trialcohort.plans.driver_queries import DOCUMENT_KEYWORDS
from trialcohort.plans.standins import KEYWORDS

CTES: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def with_steps(query: str) -> str:
    """The query with the CTEs it names, and those these name, in front."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        words = set(re.findall(r"[a-z_0-9]+", sql))
        for name in CTES:
            if name in words and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + query


# ---- input tables -------------------------------------------------------------------------------

CTES["in_studies"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id,
       CASE WHEN o_orderpriority < '3' THEN 'INTERVENTIONAL' ELSE 'OBSERVATIONAL' END AS study_type,
       o_orderstatus = 'F' AS is_fda_regulated_drug,
       o_orderstatus = 'P' AS is_fda_regulated_device,
       CASE WHEN o_orderstatus <> 'O' THEN o_custkey % 2 = 0 END AS is_unapproved_device,
       o_orderstatus AS overall_status,
       CASE WHEN o_custkey % 50 <> 7 THEN CAST(floor(o_totalprice / 2000) AS BIGINT) END AS enrollment,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'not given'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date,
       strftime(o_orderdate + INTERVAL 400 DAY, '%Y-%m-%d') AS completion_date,
       o_orderpriority AS phase,
       o_custkey % 5 AS number_of_arms,
       'Study with priority ' || o_orderpriority AS official_title
FROM orders"""

CTES["in_eligibilities"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id,
       CASE WHEN o_orderstatus = 'F' THEN 'PROBABILITY_SAMPLE' END AS sampling_method,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'FEMALE' ELSE 'ALL' END AS gender,
       (o_custkey % 18) || ' Years' AS minimum_age,
       CASE WHEN o_custkey % 3 = 0 THEN '65 Years' END AS maximum_age
FROM orders"""

CTES["in_countries"] = """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS nct_id, n_name AS name
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""

CTES["in_values"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id, o_totalprice > 250000 AS were_results_reported FROM orders"""

CTES["in_counts"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS nct_id, 'BG00' || l_linenumber AS ctgov_group_code,
       CAST(max(l_quantity) AS BIGINT) AS count
FROM lineitem GROUP BY 1, 2"""

CTES["in_measurements"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS nct_id, 'BG00' || l_linenumber AS ctgov_group_code,
       nullif(l_returnflag, 'N') AS classification,
       CASE WHEN l_linestatus = 'O' THEN 'C' || CAST(round(l_discount * 100) AS INTEGER) END AS category,
       CASE l_suppkey % 6 WHEN 0 THEN 'Age, Categorical' WHEN 1 THEN 'Sex: Female, Male'
            WHEN 2 THEN 'RACE (NIH/OMB)' WHEN 3 THEN 'Region of Enrollment' WHEN 4 THEN 'Age, Continuous'
            ELSE 'Weight' END AS title,
       'Participants' AS units,
       CASE WHEN l_suppkey % 6 = 4 THEN 'MEAN' WHEN l_partkey % 20 = 3 THEN 'MEDIAN'
            ELSE 'COUNT_OF_PARTICIPANTS' END AS param_type,
       CASE WHEN l_tax = 0.08 THEN -1.0 WHEN l_tax <> 0.07 THEN l_quantity END AS param_value_num
FROM lineitem"""

CTES["in_interventions"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS nct_id,
       CASE p_type WHEN 'ECONOMY' THEN 'DEVICE' WHEN 'PROMO' THEN 'COMBINATION DEVICE' ELSE p_type END
           AS intervention_type,
       CASE WHEN p_size > 1 THEN p_name END AS name,
       p_brand || ' ' || p_type AS description
FROM lineitem JOIN part ON l_partkey = p_partkey"""

CTES["in_sponsors"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS nct_id, c_mktsegment AS agency_class, 'lead' AS lead_or_collaborator
FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), nullif(r_name, 'ASIA'), 'collaborator'
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""

CONCEPT = "(p_partkey // 4)"
TERM = f"p_name || ' ' || {CONCEPT}"
CODE = (
    f"chr(CAST(65 + {CONCEPT} % 26 AS INTEGER)) || lpad(CAST(({CONCEPT} * 7 + p_size % 3) % 100 AS VARCHAR), 2, '0')"
    " || '.' || (p_partkey % 10)"
)

CTES["in_conditions"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS nct_id,
       CASE WHEN l_tax > 0.04 THEN upper({TERM}) ELSE {TERM} END AS mesh_term
FROM lineitem JOIN part ON l_partkey = p_partkey"""

CTES["in_map_1"] = f"SELECT {CODE} AS icd, 'D' || {CONCEPT} AS mesh FROM part"

CTES["in_map_2"] = f"""
SELECT chr(CAST(66 + {CONCEPT} % 25 AS INTEGER)) || lpad(CAST({CONCEPT} % 100 AS VARCHAR), 2, '0') AS icd,
       CASE WHEN p_type = 'PROMO' THEN 'D' || {CONCEPT} END AS mesh
FROM part"""

CTES["in_terms"] = f"""
SELECT {TERM} AS label, CASE WHEN p_size % 3 <> 0 THEN {CODE} END AS icd_code,
       CASE WHEN p_size % 4 = 0 THEN 'X' ELSE 'D' END || {CONCEPT} AS mesh_code
FROM part"""

CTES["in_trial_icd"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS nct,
       CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN 'C7A.1' WHEN o_custkey % 17 = 0 THEN 'A1'
            ELSE CASE WHEN o_custkey % 7 = 0 THEN ' ' ELSE '' END || chr(CAST(97 + o_custkey % 26 AS INTEGER))
                 || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')
                 || CASE WHEN o_custkey % 2 = 0 THEN '.1' ELSE '' END END AS icd
FROM orders"""

CTES["in_census"] = """
SELECT n_name AS country, strftime(o_orderdate, '%Y') AS year,
       CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS male,
       CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS female,
       CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS age_lt18,
       CAST(count(*) FILTER (o_orderpriority = '2-HIGH') AS DOUBLE) AS age_18_65,
       CAST(count(*) FILTER (o_orderpriority = '3-MEDIUM') AS DOUBLE) AS age_gt65,
       CAST(count(*) FILTER (o_totalprice > 400000) AS DOUBLE) AS white,
       CAST(count(*) FILTER (o_totalprice > 300000) AS DOUBLE) AS hispanic,
       CAST(count(*) FILTER (o_totalprice > 200000) AS DOUBLE) AS black,
       CAST(count(*) FILTER (o_totalprice > 100000) AS DOUBLE) AS am_indian,
       CAST(count(*) FILTER (o_custkey % 2 = 0) AS DOUBLE) AS asian,
       CAST(count(*) FILTER (o_custkey % 3 = 0) AS DOUBLE) AS hawaiian,
       CAST(count(*) FILTER (o_custkey % 5 = 0) AS DOUBLE) AS mixed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2"""

# ---- studies ------------------------------------------------------------------------------------

CTES["star"] = """
SELECT s.nct_id, study_type, is_fda_regulated_drug, is_fda_regulated_device, is_unapproved_device, overall_status,
       enrollment, start_date, completion_date, phase, number_of_arms, sampling_method, gender, minimum_age,
       maximum_age, name, were_results_reported
FROM in_studies s LEFT JOIN in_eligibilities e ON s.nct_id = e.nct_id
     LEFT JOIN in_countries c ON s.nct_id = c.nct_id LEFT JOIN in_values v ON s.nct_id = v.nct_id"""

CTES["sums_of_enrollment"] = """
SELECT nct_id, CAST(coalesce(sum(enrollment), 0) AS BIGINT) AS "sum_Enrollment",
       count(DISTINCT name) AS "study_Country_ct"
FROM star GROUP BY nct_id"""

CTES["values_of_enrollment"] = 'SELECT DISTINCT nct_id, enrollment AS "Enrollment" FROM star'

CTES["lists_of_countries"] = """
SELECT nct_id, 0::BIGINT AS list_part, coalesce(string_agg(name, ', ' ORDER BY name), '') AS "study_Country"
FROM star GROUP BY nct_id"""

CTES["details"] = """
SELECT DISTINCT nct_id, study_type, is_fda_regulated_drug, is_fda_regulated_device, is_unapproved_device,
       overall_status,
       strftime(try_strptime(start_date, '%Y-%m-%d'), '%m-%d-%Y') AS start_date,
       strftime(try_strptime(completion_date, '%Y-%m-%d'), '%m-%d-%Y') AS completion_date,
       phase, number_of_arms, sampling_method, gender, minimum_age, maximum_age, were_results_reported,
       strftime(try_strptime(start_date, '%Y-%m-%d'), '%Y') AS start_year,
       strftime(try_strptime(completion_date, '%Y-%m-%d'), '%Y') AS completion_year
FROM star"""


def census_columns(alias: str, prefix: str) -> str:
    names = {
        "male": "Male", "female": "Female", "age_lt18": "<18 Years", "age_18_65": "18:65 Years",
        "age_gt65": ">65 years", "white": "White", "hispanic": "Hispanic", "black": "Black",
        "am_indian": "am_Indian", "asian": "Asian", "hawaiian": "Hawaiian", "mixed": "mixed",
    }
    return ", ".join(f'{alias}.{c} AS "{prefix}{n}"' for c, n in names.items())


CTES["trial_frame"] = f"""
SELECT a.nct_id AS "NCT_id", 0::BIGINT AS list_part, "sum_Enrollment", "Enrollment", study_type AS "study_Type",
       is_fda_regulated_drug AS "FDAreg_Drug", is_fda_regulated_device AS "FDAreg_Device",
       is_unapproved_device AS "unapp_Device", overall_status AS "Status", start_date AS "st_Date",
       completion_date AS "comp_Date", phase AS "Phase", number_of_arms AS "no_Arms", sampling_method AS "Sampling",
       gender AS "e_Gender", minimum_age AS "e_min_Age", maximum_age AS "e_max_Age",
       were_results_reported AS "rep_res", start_year AS "st_Year", completion_year AS "comp_Year",
       "study_Country_ct", {census_columns("c1", "st_")}, {census_columns("c2", "comp_")}, "study_Country"
FROM sums_of_enrollment a JOIN values_of_enrollment b ON a.nct_id = b.nct_id
     JOIN lists_of_countries l ON a.nct_id = l.nct_id
     JOIN details d ON a.nct_id = d.nct_id
     LEFT JOIN in_census c1 ON c1.country = l."study_Country" AND c1.year = d.start_year
     LEFT JOIN in_census c2 ON c2.country = l."study_Country" AND c2.year = d.completion_year"""

CTES["lists_of_interventions"] = """
SELECT nct_id AS "NCT_id", 0::BIGINT AS list_part,
       string_agg(coalesce(intervention_type, '-'), ' | ' ORDER BY intervention_type NULLS FIRST, name NULLS FIRST)
           AS "Intervention",
       string_agg(coalesce(name, '-'), ' | ' ORDER BY intervention_type NULLS FIRST, name NULLS FIRST) AS "int_Name"
FROM in_interventions GROUP BY nct_id"""

CTES["lists_of_sponsors"] = """
SELECT nct_id AS "NCT_id", 0::BIGINT AS list_part,
       string_agg(coalesce(agency_class, '-'), ' | ' ORDER BY agency_class NULLS FIRST, lead_or_collaborator)
           AS "sp_Class",
       string_agg(lead_or_collaborator, ' | ' ORDER BY agency_class NULLS FIRST, lead_or_collaborator) AS "sp_Role"
FROM (SELECT DISTINCT * FROM in_sponsors) GROUP BY nct_id"""

# ---- baselines ----------------------------------------------------------------------------------


def title_case(t: str) -> str:
    return f"""CASE WHEN contains({t}, 'age') THEN 'age'
        WHEN contains({t}, 'race') OR contains({t}, 'ethnicity') THEN 'race'
        WHEN contains({t}, 'gender') OR contains({t}, 'sex') OR contains({t}, 'male') OR contains({t}, 'female')
            THEN 'gender'
        WHEN contains({t}, 'enrollment') THEN 'enrollment' END"""


CTES["titled"] = f"""
SELECT *, coalesce({title_case("lower(title)")}, 'unknown') AS cat_title FROM in_measurements"""

CTES["largest"] = """
SELECT * FROM in_counts QUALIFY count = max(count) OVER (PARTITION BY nct_id)"""

CTES["baselines"] = """
SELECT m.*, g.count FROM in_measurements m JOIN largest g
     ON m.nct_id = g.nct_id AND m.ctgov_group_code = g.ctgov_group_code
WHERE param_value_num >= 0"""

STATUS = """CASE WHEN category IS NULL AND classification IS NULL THEN 3 WHEN category IS NULL THEN 1
            WHEN classification IS NULL THEN 2 ELSE 4 END"""

CTES["all_categorised"] = f"""
SELECT *, CASE WHEN cat_title <> 'enrollment' AND nan_status = 1 THEN classification
               WHEN cat_title <> 'enrollment' AND nan_status IN (2, 4) THEN category END AS cat_exp
FROM (SELECT *, CAST({STATUS} AS BIGINT) AS nan_status FROM titled WHERE cat_title <> 'unknown')"""

CTES["categorised_total"] = f"""
SELECT *, CASE WHEN cat_title <> 'enrollment' AND nan_status = 1 THEN classification
               WHEN cat_title <> 'enrollment' AND nan_status IN (2, 4) THEN category END AS cat_exp
FROM (SELECT *, CAST({STATUS} AS BIGINT) AS nan_status
      FROM (SELECT *, {title_case("lower(title)")} AS cat_title FROM baselines) WHERE cat_title IS NOT NULL)"""

CTES["allowed"] = " UNION ALL ".join(
    f"SELECT {quoted(c)} AS cat_title, [{', '.join(quoted(n) for n in names)}] AS names"
    for c, names in CATEGORY_LABELS.items()
)

# Of the two labels of 'A' the first in the alphabet counts, which is never the second one.
CTES["label_of"] = """
SELECT cat_title, cat_exp,
       CASE WHEN cat_exp IS NULL THEN names[len(names)] WHEN cat_exp = 'A' THEN names[1] WHEN cat_exp = 'R' THEN names[2]
            WHEN cat_exp = 'C8' THEN 'Someone else' ELSE names[CAST(substr(cat_exp, 2) AS INTEGER) % len(names) + 1]
            END AS piv_cat
FROM allowed, (SELECT unnest([NULL, 'A', 'R', 'C0', 'C1', 'C2', 'C3', 'C4', 'C5', 'C6', 'C7', 'C8', 'C10']) AS cat_exp)"""


def pivot_rows(source: str) -> str:
    groups = in_list(ENROLLMENT_GROUPS)
    return f"""
SELECT *, CASE WHEN cat_title = 'enrollment' AND (coalesce(classification IN {groups}, false)
                    OR nan_status IN (1, 2, 4)) THEN NULL ELSE param_value_num END AS piv_num,
       CASE WHEN cat_title = 'enrollment' THEN CASE WHEN classification IN {groups} THEN category
            WHEN nan_status IN (1, 4) THEN classification WHEN nan_status = 2 THEN category END END AS piv_text
FROM (SELECT c.*, CASE WHEN param_type IN ('MEAN', 'MEDIAN') THEN param_type
                       WHEN c.cat_title = 'enrollment' THEN 'enrollment' ELSE l.piv_cat END AS piv_cat
      FROM {source} c LEFT JOIN label_of l
           ON c.cat_title IS NOT DISTINCT FROM l.cat_title AND c.cat_exp IS NOT DISTINCT FROM l.cat_exp)
WHERE piv_cat IS NOT NULL"""


CTES["all_pivot_rows"] = pivot_rows("(SELECT * FROM all_categorised WHERE param_value_num >= 0)")
CTES["total_pivot_rows"] = pivot_rows("categorised_total")


def places(source: str) -> str:
    return f"""
SELECT nct_id, 0::BIGINT AS list_part,
       string_agg(coalesce(piv_text, CAST(piv_num AS VARCHAR), '-'), ' | '
                  ORDER BY coalesce(piv_text, CAST(piv_num AS VARCHAR)) NULLS FIRST) AS "enroll_Country"
FROM {source} WHERE piv_cat = 'enrollment' GROUP BY nct_id"""


NUMBER_COLUMNS = {label: name for label, name in PIVOT_COLUMNS.items() if label != "enrollment"}

CTES["total_sums"] = f"""
SELECT nct_id AS "NCT_id", {", ".join(
    f'sum(piv_num) FILTER (piv_cat = {quoted(label)}) AS "{name}"' for label, name in NUMBER_COLUMNS.items())}
FROM total_pivot_rows WHERE cat_title <> 'enrollment' OR (piv_cat <> 'enrollment' AND piv_num IS NOT NULL)
GROUP BY nct_id"""

CTES["total_places"] = places("total_pivot_rows")

REPORTED = """
       CASE WHEN coalesce("am_Indian", "Asian", "Black", "Hispanic", "Hawaian", "White") IS NULL THEN 0 ELSE 1 END::BIGINT
           AS "r_Race",
       CASE WHEN coalesce("Female", "Male", "other") IS NULL THEN 0 ELSE 1 END::BIGINT AS "r_Gender",
       CASE WHEN coalesce("<18 years", ">65 years", "18:65 years", "age_Mean", "age_Median") IS NULL THEN 0 ELSE 1
           END::BIGINT AS "r_Age" """


def share(name: str, part: str) -> str:
    return f'CAST("{part}" AS DOUBLE) / CAST("Enrollment" AS DOUBLE) * 100 AS "{name}"'


SHARE_COLUMNS = ", ".join(
    share(name, part)
    for name, part in [
        ("Perc_Male", "Male"), ("Perc_Female", "Female"), ("u_Perc_Gender", "unknown_g"),
        ("Perc_<18 years", "<18 years"), ("Perc_18:65 years", "18:65 years"), ("Perc_>65 years", ">65 years"),
        ("u_Perc_Age", "unknown_a"), ("Perc_White", "White"), ("Perc_Black", "Black"),
        ("Perc_Hispanic", "Hispanic"), ("Perc_Asian", "Asian"), ("Perc_Other", "R_other"),
        ("u_Perc_Race", "unknown_r"),
    ]
)


def total(*names: str) -> str:
    return "(0.0::DOUBLE" + "".join(f' + coalesce("{n}", 0.0::DOUBLE)' for n in names) + ")"


REST = ["Perc_Black", "Perc_Other", "Perc_Hispanic", "Perc_Asian"]


def represented(source: str) -> str:
    """Reported flags, shares and checks on rows with Enrollment and the number columns."""
    return f"""
SELECT *, {total("c_Perc_White", *REST)} BETWEEN 0 AND 100 AS "c_100_perc_r"
FROM (SELECT *, CASE WHEN ">100_perc_r" THEN "Perc_White" - "Perc_Hispanic" ELSE "Perc_White" END AS "c_Perc_White"
      FROM (SELECT *, {total("Perc_White", *REST)} > 100 AS ">100_perc_r",
                   {total("Perc_<18 years", "Perc_>65 years", "Perc_18:65 years")} > 100 AS ">100_perc_a",
                   {total("Perc_Female", "Perc_Male")} > 100 AS ">100_perc_g"
            FROM (SELECT *, {SHARE_COLUMNS}
                  FROM (SELECT * REPLACE (nullif("Enrollment", 0) AS "Enrollment"),
                               "am_Indian" + "Hawaian" AS "R_other", {REPORTED}
                        FROM ({source})))))"""


# ---- text ---------------------------------------------------------------------------------------

CTES["trial_texts"] = """
SELECT s.nct_id, 0::BIGINT AS list_part, official_title, intervention_type, name, q_3_desc, q_7_desc, title, q_8_desc,
       measure, q_9_desc, q_10_desc
FROM (SELECT DISTINCT nct_id, official_title FROM in_studies) s
LEFT JOIN (SELECT nct_id,
           coalesce(string_agg(DISTINCT intervention_type, ';' || chr(10) || ' ' ORDER BY intervention_type), '')
               AS intervention_type,
           coalesce(string_agg(DISTINCT name, ';' || chr(10) || ' ' ORDER BY name), '') AS name,
           coalesce(string_agg(DISTINCT description, ';' || chr(10) || ' ' ORDER BY description), '') AS q_3_desc
           FROM in_interventions GROUP BY nct_id) i ON s.nct_id = i.nct_id
LEFT JOIN (SELECT CAST(doc_id AS VARCHAR) AS nct_id,
           coalesce(string_agg(DISTINCT text, ';' || chr(10) || ' ' ORDER BY text), '') AS q_7_desc
           FROM documents GROUP BY 1) d ON s.nct_id = d.nct_id
LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS nct_id,
           coalesce(string_agg(DISTINCT role, ';' || chr(10) || ' ' ORDER BY role), '') AS title,
           coalesce(string_agg(DISTINCT text, ';' || chr(10) || ' ' ORDER BY text), '') AS q_8_desc
           FROM conversations GROUP BY 1) c ON s.nct_id = c.nct_id
LEFT JOIN (SELECT CAST(page_id AS VARCHAR) AS nct_id,
           coalesce(string_agg(DISTINCT url, ';' || chr(10) || ' ' ORDER BY url), '') AS measure,
           coalesce(string_agg(DISTINCT html, ';' || chr(10) || ' ' ORDER BY html), '') AS q_9_desc
           FROM pages GROUP BY 1) p ON s.nct_id = p.nct_id
LEFT JOIN (SELECT CAST(item_id AS VARCHAR) AS nct_id,
           coalesce(string_agg(DISTINCT text, ';' || chr(10) || ' ' ORDER BY text), '') AS q_10_desc
           FROM benchmark GROUP BY 1) b ON s.nct_id = b.nct_id"""

_EDGE = r"[^\p{L}\p{N}_]"


def hits(column: str, keywords: list[str]) -> str:
    """Sorted distinct keywords in the column. Each non-word character is doubled first, so that two
    neighbouring matches can both use up an edge; there are no look-arounds here."""
    words = "|".join(re.sub(r"\W", lambda m: re.escape(m.group()) * 2, k) for k in clean_keywords(keywords))
    spaced = f"regexp_replace(lower(coalesce({column}, '')), '({_EDGE})', '\\1\\1', 'g')"
    found = f"regexp_extract_all({spaced}, '(?:^|{_EDGE})({words})(?:$|{_EDGE})', 1)"
    single = f"lambda w: regexp_replace(w, '({_EDGE}){_EDGE}', '\\1', 'g')"
    return f"list_sort(list_distinct(list_transform({found}, {single})))"


def as_text(items: str) -> str:
    return f"array_to_string({items}, ' | ')"


CTES["document_hits"] = f"""
SELECT *, {hits("text", DOCUMENT_KEYWORDS)} AS in_text, {hits("source", DOCUMENT_KEYWORDS)} AS in_source
FROM documents"""

CTES["conversation_hits"] = f"""
SELECT *, {hits("text", ["par la", "of the", "assistant"])} AS in_text,
       {hits("role", ["par la", "of the", "assistant"])} AS in_role
FROM conversations"""

CTES["text_hits"] = f"""
SELECT nct_id, intervention_type, {", ".join(f"{hits(c, KEYWORDS)} AS in_{c}" for c in SEARCHED_COLUMNS)}
FROM trial_texts"""

CTES["digital"] = f"""
SELECT nct_id, CAST(flagged AS BIGINT) AS "DHT",
       CAST(len(in_name) > 0 OR (coalesce(contains(intervention_type, 'DEVICE'), false) AND flagged) AS BIGINT)
           AS "DINT"
FROM (SELECT *, {" OR ".join(f"len(in_{c}) > 0" for c in SEARCHED_COLUMNS)} AS flagged FROM text_hits)"""

CTES["intervention_hits"] = f"""
SELECT nct_id, intervention_type, len({hits("name", ["red widget", "hot"])}) > 0 AS named,
       len({hits("description", ["red widget", "hot"])}) > 0 AS described
FROM in_interventions"""

# ---- codes --------------------------------------------------------------------------------------

CTES["clean_map"] = """
SELECT DISTINCT regexp_replace(icd, '\\..*', '') AS icd, mesh
FROM (SELECT * FROM in_map_1 UNION ALL SELECT * FROM in_map_2)"""

CTES["codes_of_terms"] = """
SELECT DISTINCT lower(t.label) AS term, coalesce(m.icd, regexp_replace(t.icd_code, '\\..*', '')) AS icd
FROM in_terms t LEFT JOIN clean_map m ON t.mesh_code = m.mesh
WHERE t.label IS NOT NULL AND coalesce(m.icd, t.icd_code) IS NOT NULL"""

CTES["sets_of_terms"] = """
SELECT term, list_sort(list(DISTINCT c.icd)) AS codes,
       list_sort(list(DISTINCT m.mesh) FILTER (m.mesh IS NOT NULL)) AS ids
FROM codes_of_terms c LEFT JOIN clean_map m ON c.icd = m.icd GROUP BY term"""

CTES["codes_of_trials"] = """
SELECT DISTINCT nct_id AS nct, c.icd FROM in_conditions t JOIN codes_of_terms c ON lower(t.mesh_term) = c.term"""

CTES["chapters"] = " UNION ALL ".join(
    f"SELECT {quoted(a)} AS first_code, {quoted(b)} AS last_code, {quoted(label)} AS label"
    for a, b, label in ICD10_CHAPTERS
)


def prefix(code: str) -> str:
    p = f"substr(upper(trim({code})), 1, 3)"
    return f"CASE WHEN length({code}) >= 3 AND regexp_full_match({p}, '[A-Z][0-9][0-9]') THEN {p} END"


CTES["chaptered"] = f"""
SELECT c.*, coalesce(label, 'Other') AS chapter
FROM (SELECT *, {prefix("icd")} AS prefix
      FROM (SELECT nct, icd FROM codes_of_trials UNION ALL
            SELECT nct, regexp_replace(icd, '\\..*', '') FROM in_trial_icd WHERE icd IS NOT NULL)) c
LEFT JOIN chapters ON prefix BETWEEN first_code AND last_code"""

CTES["icd_of_trials"] = """
SELECT nct AS "NCT_id", string_agg(DISTINCT icd, ' | ' ORDER BY icd) AS "ICD10",
       string_agg(DISTINCT chapter, ' | ' ORDER BY chapter) AS "Clinical_Cat"
FROM chaptered GROUP BY nct"""

PART_CHAPTERS = f"""
SELECT p_partkey, code AS "ICD10", coalesce(label, 'Other') AS clinical_cat
FROM (SELECT p_partkey, {CODE} AS code FROM part WHERE p_size <> 7)
LEFT JOIN chapters ON {prefix("code")} BETWEEN first_code AND last_code"""

# ---- labels -------------------------------------------------------------------------------------

EVENT_LABELS = {
    "click": "['left', 'right', 'unknown_c']",
    "error": "['user', 'system']",
    "purchase": "['small', 'large']",
    "signup": "['new', 'again']",
    "view": "['short', 'long']",
}


def prompt_text() -> str:
    """The question as an SQL expression over cat_title, cat_exp and choices."""
    pieces = re.split(r"(\{\w+\})", PROMPT_TEMPLATE + PROMPT_SUFFIX)
    columns = {"{title}": "cat_title", "{exp}": "cat_exp", "{cat}": "choices"}
    return " || ".join(columns.get(p) or quoted(p) for p in pieces if p)


CTES["event_work"] = f"""
SELECT cat_title, cat_exp, CASE cat_title {" ".join(
    f"WHEN {quoted(c)} THEN {quoted(names)}" for c, names in EVENT_LABELS.items())} END AS choices,
    (row_number() OVER (PARTITION BY cat_title ORDER BY md5(cat_exp), cat_exp) - 1)
        // greatest(1, count(*) OVER (PARTITION BY cat_title) // 5) + 1 AS chunk
FROM (SELECT DISTINCT event_type AS cat_title, 'user ' || user_id AS cat_exp FROM events)"""

CTES["responses"] = """
SELECT CASE WHEN event_type IN ('error', 'view', 'signup') THEN NULL ELSE event_type END AS cat_title,
       CASE WHEN event_type IN ('error', 'view', 'signup') OR user_id % 4 = 0 THEN NULL
            ELSE 'user ' || user_id END AS cat_exp,
       CASE WHEN event_type IN ('error', 'view', 'signup') THEN NULL
            ELSE json_extract_string(props, '$.k') END AS piv_cat
FROM events"""

# ---- queries ------------------------------------------------------------------------------------

QUERIES: dict[str, str] = {
    "group_max_rows": """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_discount
FROM (SELECT * FROM lineitem QUALIFY l_quantity = max(l_quantity) OVER (PARTITION BY l_orderkey))
WHERE l_discount - 0.02 >= 0""",
    "study_star": "SELECT * FROM star",
    "measures": """
SELECT c.nct_id, c.ctgov_group_code, c.count, classification, category, title, units, param_type, param_value_num
FROM (SELECT * FROM in_counts UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'BG99', 0 FROM orders) c
     LEFT JOIN in_measurements m
     ON c.nct_id = m.nct_id AND c.ctgov_group_code = m.ctgov_group_code""",
    "distinct_text": """
SELECT nct_id, 0::BIGINT AS list_part,
       coalesce(string_agg(DISTINCT intervention_type, ';' || chr(10) || ' ' ORDER BY intervention_type), '') AS types,
       coalesce(string_agg(DISTINCT name, ';' || chr(10) || ' ' ORDER BY name), '') AS names
FROM in_interventions GROUP BY nct_id""",
    "title_category": "SELECT nct_id, ctgov_group_code, title, cat_title FROM titled",
    "title_rule": f"""
SELECT p_partkey, {title_case("title")} AS whole_title,
       {title_case("replace(title, 'package', CAST(p_partkey AS VARCHAR))")} AS without_age
FROM (SELECT p_partkey, p_name || ' ' || lower(p_type) || ' enrollment package ' || p_size AS title FROM part)""",
    "title_candidates": """
SELECT p_partkey, p_name, len(string_split_regex(lower(p_name), '\\s+')) AS token_ct
FROM part WHERE list_has_any(string_split_regex(lower(p_name), '\\s+'), ['ring', 'widget', 'hot'])""",
    "null_pattern_report": """
SELECT nan_status, count(DISTINCT nct_id) AS count FROM all_categorised GROUP BY nan_status""",
    "expression_pick": """
SELECT nct_id, classification, category, cat_title, nan_status, cat_exp, param_value_num FROM all_categorised""",
    "baseline_rows": "SELECT * FROM baselines",
    "categorised_baselines": "SELECT * FROM categorised_total",
    "enrollment_sums": "SELECT * FROM sums_of_enrollment",
    "enrollment_values": "SELECT * FROM values_of_enrollment",
    "country_lists": "SELECT * FROM lists_of_countries",
    "study_details": "SELECT * FROM details",
    "date_parse": """
SELECT o_orderkey, strftime(try_strptime(day, '%Y-%m-%d'), '%m-%d-%Y') AS day,
       strftime(try_strptime(day, '%Y-%m-%d'), '%Y') AS year
FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y/%m')
             WHEN '2-HIGH' THEN o_orderkey || ' days' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)""",
    "census_roles": f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, n_name AS census_country, st_year AS "st_Year",
       comp_year AS "comp_Year", {census_columns("c1", "st_")}, {census_columns("c2", "comp_")}
FROM (SELECT l_orderkey, l_linenumber, n_name, strftime(o_orderdate, '%Y') AS st_year,
             strftime(l_shipdate, '%Y') AS comp_year
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey) k
     LEFT JOIN in_census c1 ON c1.country = n_name AND c1.year = st_year
     LEFT JOIN in_census c2 ON c2.country = n_name AND c2.year = comp_year""",
    "study_frame": "SELECT * FROM trial_frame",
    "aligned_lists": "SELECT * FROM lists_of_interventions",
    "sponsor_lists": "SELECT * FROM lists_of_sponsors",
    "list_sizes": """
SELECT nct_id AS "NCT_id", count(*) AS names, CASE WHEN count(*) = 1 THEN max(name) END AS only_name,
       coalesce(string_agg(name, ', ' ORDER BY intervention_type, name), '') AS joined, 1::BIGINT AS wrapped
FROM in_interventions GROUP BY nct_id""",
    "sponsors_distinct": "SELECT DISTINCT * FROM in_sponsors",
    "sponsors_all": "SELECT * FROM in_sponsors",
    "keyword_flags": f"""
SELECT doc_id, lang, source, {as_text("in_text")} AS _text, {as_text("in_source")} AS _source,
       CAST(len(in_text) + len(in_source) > 0 AS BIGINT) AS "DHT",
       coalesce(text, '') || ' | ' || coalesce(source, '') AS "DHT_searched_text",
       {", ".join(f'''CAST(list_contains(list_concat(in_text, in_source), {quoted(k)}) AS BIGINT)
           AS "_{k.replace(' ', '_')}"''' for k in DOCUMENT_KEYWORDS)}
FROM document_hits""",
    "keyword_counts": """
SELECT "Element", count(*) AS "Count"
FROM (SELECT unnest(list_concat(in_text, in_source)) AS "Element" FROM document_hits) GROUP BY 1""",
    "keyword_matches": f"""
SELECT {as_text("in_text")} AS _text, {as_text("in_role")} AS _role,
       coalesce(text, '') || ' | ' || coalesce(role, '') AS "DHT_searched_text"
FROM conversation_hits WHERE len(in_text) + len(in_role) > 0""",
    "trial_matches": f"""
SELECT conv_id, {as_text("list_sort(list_distinct(flatten(list(in_text))))")} AS _text,
       {as_text("list_sort(list_distinct(flatten(list(in_role))))")} AS _role
FROM conversation_hits WHERE len(in_text) + len(in_role) > 0 GROUP BY conv_id""",
    "unplaced_labels": f"""
SELECT cat_title, piv_cat, count(*) AS count FROM all_pivot_rows
WHERE piv_cat NOT IN {in_list(PIVOT_COLUMNS)} GROUP BY 1, 2""",
    "trial_text": "SELECT * FROM trial_texts",
    "intervention_flags": "SELECT * FROM digital",
    "device_flags": """
SELECT nct_id, CAST(bool_or(named OR described) AS BIGINT) AS "DHT",
       CAST(bool_or(named) OR (bool_or(contains(intervention_type, 'DEVICE')) AND bool_or(named OR described)) AS BIGINT)
           AS "DINT"
FROM intervention_hits GROUP BY nct_id""",
    "sample_rows": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity
FROM lineitem WHERE l_orderkey IN (
    SELECT l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem)
    ORDER BY md5(l_orderkey || '|0'), l_orderkey LIMIT 1500)""",
    "label_expressions": """
SELECT DISTINCT cat_title, coalesce(cat_exp, 'nan') AS cat_exp FROM all_categorised WHERE cat_title <> 'enrollment'""",
    "label_requests": f"""
SELECT cat_title AS category, chunk, CAST(to_json(struct_pack(
    custom_id := 'task-' || cat_exp, method := 'POST', url := '/v1/chat/completions',
    body := struct_pack(model := {quoted(REQUEST_MODEL)}, temperature := 0, max_tokens := 200, top_p := 1,
        presence_penalty := 0, frequency_penalty := 0, response_format := struct_pack("type" := 'json_object'),
        messages := [struct_pack("role" := 'user', content := {prompt_text()})]))) AS VARCHAR) AS value
FROM event_work""",
    "label_parse": "SELECT *, coalesce(cat_title, cat_exp, piv_cat) IS NULL AS is_bad FROM responses",
    "label_table": """
SELECT cat_title, cat_exp, min(piv_cat) AS piv_cat FROM responses WHERE cat_title IS NOT NULL AND piv_cat IS NOT NULL
GROUP BY 1, 2""",
    "label_conflicts": """
SELECT cat_title, cat_exp, min(piv_cat) AS kept FROM responses WHERE piv_cat IS NOT NULL
GROUP BY 1, 2 HAVING count(DISTINCT piv_cat) > 1""",
    "null_safe_join": """
SELECT c.nct_id, ctgov_group_code, c.cat_title, c.cat_exp, l.piv_cat, param_value_num
FROM all_categorised c LEFT JOIN label_of l
     ON c.cat_title IS NOT DISTINCT FROM l.cat_title AND c.cat_exp IS NOT DISTINCT FROM l.cat_exp""",
    "pivot_values": """
SELECT nct_id, ctgov_group_code, cat_title, nan_status, piv_cat, piv_num, piv_text FROM all_pivot_rows""",
    "category_sums": """
SELECT nct_id, piv_cat, coalesce(sum(piv_num), 0) AS piv_num FROM all_pivot_rows WHERE cat_title <> 'enrollment'
GROUP BY 1, 2""",
    "pivot_sums": """
SELECT l_orderkey, sum(l_quantity) FILTER (l_returnflag = 'A') AS accepted,
       sum(l_quantity) FILTER (l_returnflag = 'N') AS none, sum(l_quantity) FILTER (l_returnflag = 'R') AS returned
FROM lineitem GROUP BY l_orderkey""",
    "enrollment_lists": places("all_pivot_rows"),
    "demographic_pivot": """
SELECT coalesce(s."NCT_id", p.nct_id) AS "NCT_id", 0::BIGINT AS list_part, s.* EXCLUDE ("NCT_id"), "enroll_Country"
FROM total_sums s FULL JOIN total_places p ON s."NCT_id" = p.nct_id""",
    "shares": represented("""
        SELECT o_orderkey, CAST(floor(o_totalprice / 5000) AS BIGINT) AS "Enrollment", f.* EXCLUDE (l_orderkey),
               "am_Indian" + "Asian" AS "Male", "White" AS "Female", NULL::DOUBLE AS "other",
               "Black" AS "<18 years", "Hispanic" AS "18:65 years", "Asian" AS ">65 years",
               NULL::DOUBLE AS "age_Mean", NULL::DOUBLE AS "age_Median", "Hawaian" AS unknown_g,
               "Hawaian" AS unknown_a, "Hawaian" AS unknown_r
        FROM orders LEFT JOIN (
            SELECT l_orderkey,
                   sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS "am_Indian",
                   sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS "Asian",
                   sum(l_quantity) FILTER (l_returnflag = 'N' AND l_linestatus = 'F') AS "Black",
                   sum(l_quantity) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS "Hispanic",
                   sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS "Hawaian",
                   sum(l_quantity) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS "White"
            FROM lineitem GROUP BY l_orderkey) f ON o_orderkey = l_orderkey"""),
    "to_numbers": """
SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS name, TRY_CAST(p_size || '.5' AS DOUBLE) AS size FROM part""",
    "code_prefixes": f"""
SELECT nct AS "NCT_id", code, {prefix("code")} AS prefix
FROM (SELECT nct, regexp_replace(icd, '\\..*', '') AS code FROM in_trial_icd)""",
    "icd_chapter": PART_CHAPTERS,
    "icd_chapter_by_range": PART_CHAPTERS,
    "code_map": 'SELECT icd AS "ICD10CM_id", mesh AS "MESH_id" FROM clean_map',
    "term_codes": 'SELECT term AS "MESH_term", icd AS "ICD10CM_id" FROM codes_of_terms',
    "term_sets": f"""
SELECT term AS "MESH_term", {as_text("codes")} AS "ICD10CM_id", coalesce({as_text("ids")}, '') AS "MESH_id"
FROM sets_of_terms""",
    "trial_codes": 'SELECT nct AS "NCT_id", icd AS "ICD10" FROM codes_of_trials',
    "trial_code_sizes": """
SELECT nct_id AS "NCT_id", count(*) AS "MESH_term_ct", CAST(sum(len(codes)) AS BIGINT) AS "ICD10CM_ct",
       CAST(sum(coalesce(len(ids), 0)) AS BIGINT) AS "MESH_id_ct"
FROM in_conditions JOIN sets_of_terms ON lower(mesh_term) = term GROUP BY nct_id""",
    "code_sets": f"""
SELECT term AS "MESH_term", string_agg(DISTINCT icd, ' | ' ORDER BY icd) AS "ICD10",
       string_agg(DISTINCT coalesce(label, 'Other'), ' | ' ORDER BY coalesce(label, 'Other')) AS "Clinical_Cat"
FROM codes_of_terms LEFT JOIN chapters ON {prefix("icd")} BETWEEN first_code AND last_code GROUP BY term""",
    "icd_map": "SELECT * FROM icd_of_trials",
    "representation": represented("""
        SELECT s.nct_id AS "NCT_id", s.enrollment AS "Enrollment", t.* EXCLUDE ("NCT_id")
        FROM in_studies s LEFT JOIN total_sums t ON s.nct_id = t."NCT_id" """),
    "wide_table": represented("""
        SELECT f.*, g."DHT", g."DINT", i."Intervention", i."int_Name", sp."sp_Class", sp."sp_Role", c."ICD10",
               c."Clinical_Cat", t.* EXCLUDE ("NCT_id"), p."enroll_Country"
        FROM trial_frame f LEFT JOIN digital g ON f."NCT_id" = g.nct_id
             LEFT JOIN lists_of_interventions i ON f."NCT_id" = i."NCT_id"
             LEFT JOIN lists_of_sponsors sp ON f."NCT_id" = sp."NCT_id"
             LEFT JOIN icd_of_trials c ON f."NCT_id" = c."NCT_id"
             LEFT JOIN total_sums t ON f."NCT_id" = t."NCT_id"
             LEFT JOIN total_places p ON f."NCT_id" = p.nct_id"""),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(query) for name, query in QUERIES.items()}
