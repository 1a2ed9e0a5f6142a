"""These must be exactly so for right results."""

# ICD-10 chapters: first code, last code, label. The first range that holds a code wins.
ICD10_CHAPTERS = [
    ("A00", "B99", "Infectious diseases"),
    ("C00", "D48", "Neoplasms"),
    ("D50", "D90", "Hematology/Immunology"),
    ("E00", "E90", "Endocrine, nutritional and metabolic diseases"),
    ("F00", "F99", "Mental Health"),
    ("G00", "G99", "Nervous system"),
    ("H00", "H59", "Eye and Adnexa"),
    ("H60", "H95", "Ear and Mastoid Process"),
    ("I00", "I99", "Circulatory System"),
    ("J00", "J99", "Respiratory System"),
    ("K00", "K93", "Digestive System"),
    ("L00", "L99", "Skin and Subcutaneous Tissue"),
    ("M00", "M99", "Musculoskeletal System and Connective Tissue"),
    ("N00", "N99", "Genitourinary System"),
    ("O00", "O99", "Pregnancy and Childbirth"),
    ("P00", "P96", "Conditions during Perinatal Period"),
    ("Q00", "Q99", "Congenital Malformations, Deformations and Chromosomal Abnormalities"),
    ("R00", "R99", "Symptoms, Signs and Abnormal Clinical and Laboratory Findings - not elsewhere classified"),
    ("S00", "T98", "Injury, Poisoning and other External Causes"),
    ("V01", "Y84", "External Causes of Morbidity and Mortality"),
    ("Z00", "Z99", "Factors influencing Health Status and Contact with Health Services"),
    ("U00", "U99", "Special purposes"),
]
NO_CHAPTER = "Other"

# The labels an expression of each category may get.
CATEGORY_LABELS = {
    "gender": ["male", "female", "other", "unknown_g"],
    "age": ["<18 years", "between 18 and 65 years", ">65 years", "unknown_a"],
    "race": [
        "American Indian or Alaska Native",
        "Asian",
        "Black or African American",
        "Hispanic or Latino",
        "Native Hawaian or Other Pacific Islander",
        "White",
        "unknown_r",
    ],
}

# Words that make a measure title worth a look when they stand alone in it.
TITLE_WORDS = ["race", "ethnicity", "gender", "sex", "male", "female", "age", "enrollment"]

# Enrollment classifications that name a group of people, so the place is in the category column.
ENROLLMENT_GROUPS = [
    "Asia",
    "Global",
    "Cohort 1",
    "Cohort 2",
    "Treatment-Naive Population",
    "ITT Population",
]

# Label -> column of the one-row-per-trial table.
PIVOT_COLUMNS = {
    "<18 years": "<18 years",
    ">65 years": ">65 years",
    "American Indian or Alaska Native": "am_Indian",
    "Asian": "Asian",
    "Black or African American": "Black",
    "Hispanic or Latino": "Hispanic",
    "MEAN": "age_Mean",
    "MEDIAN": "age_Median",
    "Native Hawaian or Other Pacific Islander": "Hawaian",
    "White": "White",
    "between 18 and 65 years": "18:65 years",
    "enrollment": "enroll_Country",
    "female": "Female",
    "male": "Male",
    "other": "other",
    "unknown_a": "unknown_a",
    "unknown_g": "unknown_g",
    "unknown_r": "unknown_r",
}

# Columns of the studies, one row per trial and country.
STUDY_COLUMNS = [
    "nct_id",
    "study_type",
    "is_fda_regulated_drug",
    "is_fda_regulated_device",
    "is_unapproved_device",
    "overall_status",
    "enrollment",
    "start_date",
    "completion_date",
    "phase",
    "number_of_arms",
    "sampling_method",
    "gender",
    "minimum_age",
    "maximum_age",
    "name",
    "were_results_reported",
]

# Study column -> column of the trial frame.
TRIAL_NAMES = {
    "nct_id": "NCT_id",
    "study_type": "study_Type",
    "is_fda_regulated_drug": "FDAreg_Drug",
    "is_fda_regulated_device": "FDAreg_Device",
    "is_unapproved_device": "unapp_Device",
    "overall_status": "Status",
    "start_date": "st_Date",
    "completion_date": "comp_Date",
    "phase": "Phase",
    "number_of_arms": "no_Arms",
    "sampling_method": "Sampling",
    "gender": "e_Gender",
    "minimum_age": "e_min_Age",
    "maximum_age": "e_max_Age",
    "were_results_reported": "rep_res",
    "start_year": "st_Year",
    "completion_year": "comp_Year",
}

# Census column -> name after the role prefix st_ or comp_.
CENSUS_NAMES = {
    "male": "Male",
    "female": "Female",
    "age_lt18": "<18 Years",
    "age_18_65": "18:65 Years",
    "age_gt65": ">65 years",
    "white": "White",
    "hispanic": "Hispanic",
    "black": "Black",
    "am_indian": "am_Indian",
    "asian": "Asian",
    "hawaiian": "Hawaiian",
    "mixed": "mixed",
}

# Share column -> the figure it is a share of enrollment of.
SHARES = {
    "Perc_Male": "Male",
    "Perc_Female": "Female",
    "u_Perc_Gender": "unknown_g",
    "Perc_<18 years": "<18 years",
    "Perc_18:65 years": "18:65 years",
    "Perc_>65 years": ">65 years",
    "u_Perc_Age": "unknown_a",
    "R_other": None,
    "Perc_White": "White",
    "Perc_Black": "Black",
    "Perc_Hispanic": "Hispanic",
    "Perc_Asian": "Asian",
    "Perc_Other": "R_other",
    "u_Perc_Race": "unknown_r",
}

# Text columns searched for keywords, in the order they are joined.
SEARCHED_COLUMNS = [
    "official_title",
    "name",
    "q_3_desc",
    "q_7_desc",
    "title",
    "q_8_desc",
    "measure",
    "q_9_desc",
    "q_10_desc",
]
TEXT_SEPARATOR = ";\n "

# The question sent for one expression; {exp}, {cat} and {title} are filled in.
PROMPT_TEMPLATE = """
You are provided with a labeling task: label the phrase {exp} with one and only 
one of the labels in the list {cat}. Output the result as a list:

['cat_title', 'cat_exp', 'piv_cat'],

where

'cat_title' = {title},
'cat_exp' = {exp}
and 'piv_cat' designates the assigned label from list {cat}.
"""
PROMPT_SUFFIX = " Please respond in JSON format."
REQUEST_MODEL = "gpt-4o-mini"
REQUEST_URL = "/v1/chat/completions"
REQUEST_SETTINGS = {
    "temperature": 0,
    "max_tokens": 200,
    "top_p": 1,
    "presence_penalty": 0,
    "frequency_penalty": 0,
}
REQUEST_CHUNKS = 5

# Titles of measures picked by hand; letter case aside, a title must be one of them, blanks included.
CURATED_TITLES = [
    "Age",
    "Age (<60 or ≥60 years)",
    "Age (Statistics)",
    "Age (Strata per Randomization)",
    "Age (categorical)",
    "Age (years)",
    "Age (years) (categorical)",
    "Age - Part 1 population",
    "Age 65 or above",
    "Age > 15 years",
    "Age > 60 years",
    "Age >/= 60 years",
    "Age >65 years",
    "Age Categorical",
    "Age Categorical (≤65 or >65 Years Old)",
    "Age Categories",
    "Age Categorization, Female Only",
    "Age Characterization Female Only",
    "Age Classification",
    "Age Continous",
    "Age Continuous",
    "Age Continuous (China Substudy)",
    "Age Continuous (PEP)",
    "Age Continuous in Follicular Lymphoma Sub-Population",
    "Age Continuous, without Noncompliant Site",
    "Age Customized",
    "Age Customized, by Disease Type",
    "Age Group",
    "Age Range",
    "Age Strata",
    "Age Strata per Randomization",
    "Age at Enrollment",
    "Age at randomization (hours)",
    "Age at study enrollment",
    "Age at time of randomization",
    "Age by Sex",
    "Age categorical",
    "Age categories",
    "Age categorization Females Only",
    "Age continuous- adults subjects",
    "Age continuous-pediatric study",
    "Age end of study",
    "Age group",
    "Age group at randomization",
    "Age of participant",
    "Age of participants",
    "Age of participants by 10-year age groups",
    "Average of site-level mean age",
    "Average participant age +/- SD",
    "Black Race",
    "Black race",
    "Child Age",
    "Child age",
    "Child age (years), median (IQR)",
    "Child's Age",
    "Child's Age at Consent",
    "Child's Gender",
    "Child's Sex",
    "Child's Sex: Female, Male",
    "Child's age",
    "Chronological age",
    "Current Gender Identity",
    "Distribution of age",
    "Enrollment by Country",
    "Ethnicity",
    "Ethnicity ( NIH/OMB)",
    "Ethnicity (Asia)",
    "Ethnicity (NIH/OMB)",
    "Ethnicity (NIH/OMB) (Influenza Season 2015-2016)",
    "Ethnicity (NIH/OMB) (Influenza Season 2016-2017)",
    "Ethnicity Origin",
    "EudraCT Age Categories",
    "Female Age",
    "Female Age Category",
    "Female Age, Continuous",
    "Female age, customized",
    "Gender",
    "Gender (China Substudy)",
    "Gender - Part 1 Population",
    "Gender Identity",
    "Geographic Region of Enrollment",
    "Infant - age at randomization",
    "Infant mean gestational age",
    "Infant sex at birth",
    "Location at Enrollment",
    "Location of Enrollment",
    "Location of enrollment",
    "Median Age (Range)",
    "Median Age Categories",
    "Median age",
    "Participating child age (years)",
    "Patient Sex: Female, Male",
    "Patients age were between 30-69 years",
    "Patients enrolled were female gender over the age of 18.",
    "Phase I: Youth Hispanic/ Latinx Ethnicity",
    "Phase I: Youth Race",
    "Phase I: Youth age",
    "Phase II: Youth Hispanic/ Latinx Ethnicity",
    "Phase II: Youth age",
    "Primary Race",
    "Protocol-defined Age Cohorts (All Participants As Treated Population)",
    "RACE",
    "RACE (NIH/OMB)",
    "Race",
    "Race & Ethnicity",
    "Race (Asian vs Non-Asian) at Randomization",
    "Race (NIH/OMB)",
    "Race (NIH/OMB) (Influenza Season 2015-2016)",
    "Race (NIH/OMB) (Influenza Season 2016-2017)",
    "Race (PEP)",
    "Race - Peru",
    "Race - Puerto Rico",
    "Race - South Africa",
    "Race - Thailand",
    "Race - U.S.A.",
    "Race / Ethnicity",
    "Race Categories",
    "Race Class",
    "Race Customized",
    "Race [Caucasian / White]",
    "Race class",
    "Race or ethnicity",
    "Region Of Enrollment",
    "Region of Enrollment",
    "Region of enrollment",
    "Risk Factor at Enrollment: Age >= 75 Years",
    "Sex Assigned at Birth",
    "Sex and gender",
    "Sex of the Infant",
    "Sex: Female, Male",
    "Stratification Factor at Randomization Collected via IRT: Age Group",
    "Stratification Factor: Age",
    "Stratification Factor: Age Category",
    "Stratification Factor: Age Group",
    "Stratification Factor: Region of Enrollment",
    "Study Enrollment",
    "SubStudy 1: Age",
    "SubStudy 1: Ethnicity",
    "SubStudy 1: Race",
    "SubStudy 1: Sex",
    "SubStudy 2: Age",
    "SubStudy 2: Ethnicity",
    "SubStudy 2: Race",
    "SubStudy 2: Sex",
    "Subject Classification: Mean Age",
    "Subject characteristic - subject age",
    "Toddler age",
    "White race",
    "age",
    "age in years",
    "child age",
    "enrollment",
    "ethnicity",
    "race",
    "Child sex",
    "Child Sex at Birth",
    "Phase I: Youth sex",
    "Child Race",
    "Infant sex",
    "Child Ethnicity",
    "Gender of child",
    "Toddler sex",
    "Phase II: Youth sex",
    "Child Gender",
    "Participating child sex",
    "Phase II: Youth race",
    "Child's gender",
    "Age, Continuous",
    "Age, Categorical",
    "Child Hispanic Ethnicity",
    "Child gender",
    "Age, Continous: Dose Maintenance Period",
    "Age, Continuous (Influenza Season 2015-2016)",
    "Age, Continuous (Influenza Season 2016-2017)",
    "Age, Continuous, Compliant Participants",
    "Age, Customized",
    "Age, continuous: Period 2 (trial enrollment, induction ART)",
    "Age, continuous: Period 3 (randomization to once vs twice daily ABC+3TC)",
    "Age, continuous: Period 4 (randomization to stop versus continue cotrimoxazole)",
    "Age, customized",
    "Age-Categorical",
    "AgeCategorical",
    "AgeCategoricalOther",
    "Country of Enrollment",
    "Enrollment",
    "Enrollment Characteristics",
    "Enrollment Parameters",
    "Enrollment by Region",
    "Ethnicity, Customized",
    "Ethnicity, without Noncompliant Site",
    "Ethnicity/Race",
    "Ethnicity: Caucasian, Non-Caucasian",
    "Ethnicity: Spanish, Hispanic or Latino",
    "Gender at Beginning of Long term Follow-up Period",
    "Gender in patients completing study",
    "Gender, Male/Female: Compliant Participants",
    "Patient Age, Continuous",
    "Race (NIH/OMB): Dose Maintenance Period",
    "Race, Compliant Participants",
    "Race, Customized",
    "Race, without Noncompliant Site",
    "Race-Ethnicity",
    "Race/Ethnicity",
    "Race/Ethnicity, Customized",
    "Race/Ethnicity, customized",
    "Race/ethnicity",
    "Race: Extension Phase",
    "Region of Enrollment, Customized",
    "Region of Enrollment: United States",
    "Sex/Gender, Customized",
    "Sex: Female, Male (Influenza Season 2015-2016)",
    "Sex: Female, Male (Influenza Season 2016-2017)",
    "Sex: Female, Male (PEP)",
    "Sex: Female, Male: Dose Maintenance Period",
    "Study Specific Race/Ethnicity",
    "Toddler race/ethnicity",
    " Age",
]
