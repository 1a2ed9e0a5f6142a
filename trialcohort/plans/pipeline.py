"""The whole job: registry tables in, one wide row per trial out."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialcohort.functions.fixed_values import CENSUS_NAMES, PIVOT_COLUMNS, REQUEST_CHUNKS, SHARES
from trialcohort.operators.baseline import (
    baseline_rows,
    categorise,
    null_pattern_report,
    title_dictionary,
)
from trialcohort.operators.icd import chapter_frame, icd_map
from trialcohort.operators.joins import union_all
from trialcohort.operators.labels import (
    label_conflicts,
    label_requests,
    label_table,
    parse_responses,
    unique_labels,
)
from trialcohort.operators.paging import PAGE_SIZE, Family, list_rows, paged_lists
from trialcohort.operators.represent import (
    demographic_sums,
    enrollment_family,
    enrollment_rows,
    representation,
    unplaced_labels,
    with_labels,
    with_pivot_columns,
)
from trialcohort.operators.sampling import sample_ids
from trialcohort.operators.study import (
    country_family,
    fact_columns,
    joined_countries,
    packed_facts,
    study_base,
    study_star,
    with_lists,
)
from trialcohort.operators.text_flags import (
    PAGE_BYTES,
    all_texts,
    keyword_counts,
    keyword_flags,
    trial_flags,
    trial_matches,
    trial_text,
)
from trialcohort.plans.staging import written
from trialcohort.sources.readers import (
    bad_values,
    keyword_list,
    raw_csv,
    read_csv,
    read_database,
    read_lines,
    read_parquet,
    read_tsv,
)
from trialcohort.sources.schemas import REGISTRY_TABLES, SCHEMAS
from trialcohort.sources.shared import staged
from trialcohort.sources.writers import write_csv, write_parquet, write_requests

SLICE_ROWS = 60_000_000  # rows of lists that are put together with their trials at a time

CODE_MAPS = ("code_map_1", "code_map_2")


@dataclass(frozen=True)
class Inputs:
    """Every table the job reads.

    `titles` is a (title_lc, category) dictionary of curated titles; without one the titles shipped count.
    `responses` are the parsed response lines that the labels came from, for reports on them.
    """

    studies: DataFrame
    eligibilities: DataFrame
    countries: DataFrame
    calculated_values: DataFrame
    baseline_counts: DataFrame
    baseline_measurements: DataFrame
    interventions: DataFrame
    sponsors: DataFrame
    browse_conditions: DataFrame
    brief_summaries: DataFrame
    design_groups: DataFrame
    design_outcomes: DataFrame
    detailed_descriptions: DataFrame
    census: DataFrame
    labels: DataFrame
    code_map_1: DataFrame
    code_map_2: DataFrame
    mesh_icd: DataFrame
    trial_icd: DataFrame
    keywords: Sequence[str]
    titles: DataFrame | None = None
    responses: DataFrame | None = None


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_inputs(spark: SparkSession, folder: str, file_format: str = "parquet", responses: str | None = None) -> Inputs:
    """All input tables of a folder, each in `<table>.parquet` or `<table>.csv` (a file or a folder).

    Code maps may be `<table>.tsv` in either format. The titles may be missing: those shipped count then. The labels come from response
    lines when their folder is given.
    """

    def table(name: str) -> DataFrame:
        if name in CODE_MAPS and exists(spark, f"{folder}/{name}.tsv"):
            return read_tsv(spark, f"{folder}/{name}.tsv", name)
        path = f"{folder}/{name}.{file_format}"
        return read_csv(spark, path, name) if file_format == "csv" else read_parquet(spark, path, name)

    extra = ("titles", "labels", "keywords", "responses")
    names = [f.name for f in fields(Inputs) if f.name not in extra]
    titled = exists(spark, f"{folder}/titles.{file_format}")
    lines = None if responses is None else read_lines(spark, responses)
    return Inputs(
        **{name: table(name) for name in names},
        titles=title_dictionary(table("titles")) if titled else None,
        labels=table("labels") if lines is None else label_table(lines),
        responses=None if lines is None else parse_responses(lines),
        keywords=keyword_list(table("keywords")),
    )


def input_report(spark: SparkSession, folder: str, file_format: str = "parquet") -> DataFrame:
    """(table, column, count) of input texts that do not fit their declared type."""
    found = []
    for name in SCHEMAS:
        path = f"{folder}/{name}.{file_format}"
        if exists(spark, path):
            raw = raw_csv(spark, path) if file_format == "csv" else spark.read.parquet(path)
            found.append(bad_values(raw, name))
    return union_all(*found)


def extract(spark: SparkSession, url: str, bounds: list[str], properties: dict[str, str], out: str, tasks: int = 32) -> None:
    """Copies the registry's base tables from its database to parquet below `out`."""
    for name in REGISTRY_TABLES:
        write_parquet(read_database(spark, url, name, bounds, properties, tasks=tasks), f"{out}/{name}.parquet")


TRIAL_COLUMNS = [
    "NCT_id", "sum_Enrollment", "Enrollment", "study_Country", "study_Type", "FDAreg_Drug", "FDAreg_Device",
    "unapp_Device", "Status", "st_Date", "comp_Date", "Phase", "no_Arms", "Sampling", "e_Gender", "e_min_Age",
    "e_max_Age", "rep_res", "st_Year", "comp_Year",
]

COLUMNS = [
    *TRIAL_COLUMNS,
    *["st_" + name for name in CENSUS_NAMES.values()],
    *["comp_" + name for name in CENSUS_NAMES.values()],
    "study_Country_ct",
    *["DHT", "DINT", "Intervention", "int_Name", "sp_Class", "sp_Role", "ICD10", "Clinical_Cat"],
    *PIVOT_COLUMNS.values(),
    *["r_Race", "r_Gender", "r_Age"],
    *SHARES,
    *[">100_perc_r", ">100_perc_a", ">100_perc_g", "c_Perc_White", "c_100_perc_r"],
]


def intervention_family(interventions: DataFrame) -> Family:
    return Family(interventions, "nct_id", {"intervention_type": "Intervention", "name": "int_Name"})


def intervention_lists(interventions: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(NCT_id, list_part, Intervention, int_Name): types and names of a trial's interventions, aligned."""
    return paged_lists([intervention_family(interventions)], "NCT_id", page_size)


def distinct_sponsors(sponsors: DataFrame) -> DataFrame:
    return sponsors.select("nct_id", "agency_class", "lead_or_collaborator").distinct()


def sponsor_family(sponsors: DataFrame) -> Family:
    columns = {"agency_class": "sp_Class", "lead_or_collaborator": "sp_Role"}
    return Family(sponsors, "nct_id", columns, distinct=True)


def sponsor_lists(sponsors: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(NCT_id, list_part, sp_Class, sp_Role): distinct classes and roles of a trial's sponsors, aligned."""
    return paged_lists([sponsor_family(sponsors)], "NCT_id", page_size)


def in_slice(key: str, i: int, slices: int) -> Column:
    """Whether a trial is in slice i, by a hash of its id, so that all tables are cut alike."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slices)) == i


def wide_table(
    base: DataFrame,
    countries: DataFrame,
    census: DataFrame,
    flags: DataFrame,
    interventions: DataFrame,
    sponsors: DataFrame,
    icd: DataFrame,
    categorised: DataFrame,
    labels: DataFrame,
    page_size: int = PAGE_SIZE,
    keep: Callable[[DataFrame, str], DataFrame] = staged,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The 93 columns, and list_part: 0 but for rows that carry on lists longer than `page_size`.

    `flags` is (nct_id, DHT, DINT). The lists of all families are folded in the same shuffles. `keep` writes a table under
    a name and reads it back: the rows of the lists, which are counted before they are gathered. Where they are more than
    `slice_rows`, slices of all trials are put together one after the other and kept, so that shuffles take the disk of a
    slice; what the slices share is kept before.
    """
    families = [
        country_family(countries),
        intervention_family(interventions),
        sponsor_family(sponsors),
        enrollment_family(enrollment_rows(categorised)),
    ]
    listed = keep(list_rows(families, "NCT_id"), "list_rows")
    slices = -(-listed.count() // slice_rows)
    known = unique_labels(labels)
    if slices < 2:
        return wide_rows(base, census, flags, icd, categorised, known, families, listed, page_size)
    base, census, flags, known = (
        keep(df, f"wide_{name}") for df, name in ((base, "base"), (census, "census"), (flags, "flags"), (known, "labels"))
    )
    found = []
    for i in range(slices):
        own = [df.filter(in_slice(key, i, slices)) for df, key in ((base, "nct_id"), (flags, "nct_id"), (icd, "NCT_id"), (categorised, "nct_id"), (listed, "NCT_id"))]
        rows = wide_rows(own[0], census, own[1], own[2], own[3], known, families, own[4], page_size)
        found.append(keep(rows, f"wide_rows_{i}"))
    return union_all(*found)


def wide_rows(
    base: DataFrame,
    census: DataFrame,
    flags: DataFrame,
    icd: DataFrame,
    categorised: DataFrame,
    labels: DataFrame,
    families: Sequence[Family],
    listed: DataFrame,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """The rows of wide_table for the trials in base. listed: the rows of list_rows of these trials, with the countries first."""
    named = listed.filter("__family = 0").select(F.col("NCT_id").alias("nct_id"), F.col("__b").alias("name"))
    trials = (
        packed_facts(base, named, census)
        .join(flags.withColumnRenamed("nct_id", "NCT_id"), "NCT_id", "left")
        .join(icd, "NCT_id", "left")
    )
    sums = demographic_sums(categorised, labels)
    wide = with_lists(representation(trials, sums), paged_lists(families, "NCT_id", page_size, every_row=listed))
    columns = fact_columns() | {"study_Country": joined_countries()}
    return wide.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in COLUMNS], "list_part")


def categorised_baselines(inputs: Inputs, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    return categorise(baseline_rows(inputs.baseline_counts, inputs.baseline_measurements, keep), inputs.titles)


def text_tables(inputs: Inputs) -> dict[str, DataFrame]:
    return {
        "interventions": inputs.interventions,
        "summaries": inputs.brief_summaries,
        "groups": inputs.design_groups,
        "outcomes": inputs.design_outcomes,
        "descriptions": inputs.detailed_descriptions,
    }


def sampled(inputs: Inputs, sample_n: int | None, seed: int = 0) -> Inputs:
    """Inputs whose studies, as far as their text goes, are a repeatable sample of the trials."""
    if sample_n is None:
        return inputs
    ids = sample_ids(inputs.studies, "nct_id", sample_n, seed)
    return replace(inputs, studies=inputs.studies.join(ids, "nct_id", "left_semi"))


def text_of(inputs: Inputs, page_bytes: int = PAGE_BYTES) -> DataFrame:
    return trial_text(inputs.studies, **text_tables(inputs), page_bytes=page_bytes)


def icd_of(inputs: Inputs, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    chapters = chapter_frame(inputs.studies.sparkSession)
    return icd_map(
        inputs.code_map_1,
        inputs.code_map_2,
        inputs.mesh_icd,
        inputs.browse_conditions,
        inputs.trial_icd,
        chapters,
        keep,
    )


def base_of(inputs: Inputs) -> DataFrame:
    return study_base(inputs.studies, inputs.eligibilities, inputs.calculated_values)


def star_of(inputs: Inputs) -> DataFrame:
    return study_star(inputs.studies, inputs.eligibilities, inputs.countries, inputs.calculated_values)


def flags_of(
    inputs: Inputs, sample_n: int | None = None, seed: int = 0, page_bytes: int = PAGE_BYTES
) -> DataFrame:
    """Keyword flags with the text of all trials, or of a repeatable sample of them, picked before text is folded."""
    return keyword_flags(text_of(sampled(inputs, sample_n, seed), page_bytes), inputs.keywords)


def trial_flags_of(inputs: Inputs, sample_n: int | None = None, seed: int = 0) -> DataFrame:
    """(nct_id, DHT, DINT) of all trials, or of a sample; texts are searched where they lie."""
    chosen = sampled(inputs, sample_n, seed)
    return trial_flags(chosen.studies, all_texts(chosen.studies, **text_tables(inputs)), inputs.keywords)


def unplaced_labels_of(categorised: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels that no column takes in, with the number of their rows."""
    return unplaced_labels(with_pivot_columns(with_labels(categorised, unique_labels(labels))))


def build_all(
    inputs: Inputs, sample_n: int | None = None, seed: int = 0, page_size: int = PAGE_SIZE, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The wide table over tables that are written first: largest groups, baselines, codes and rows of lists, which several
    of its steps or slices read or whose shuffles needn't stay, and the slices where wide_table makes several."""
    return wide_table(
        base_of(inputs),
        inputs.countries,
        inputs.census,
        trial_flags_of(inputs, sample_n, seed),
        inputs.interventions,
        inputs.sponsors,
        icd_of(inputs, staged),
        staged(categorised_baselines(inputs, staged), "baselines"),
        inputs.labels,
        page_size,
        slice_rows=slice_rows,
    )


def write_label_requests(inputs: Inputs, path: str, chunks: int = REQUEST_CHUNKS, label_missing: bool = False) -> None:
    """First job: the request lines for expressions that need a label."""
    write_requests(label_requests(categorised_baselines(inputs), chunks=chunks, label_missing=label_missing), path)


def run(
    inputs: Inputs, out: str, sample_n: int | None = None, seed: int = 0, all_labels_needed: bool = False
) -> DataFrame:
    """Second job, with the labels in: writes every stage below `out` and the wide table as parquet and CSV.

    `out` is a folder all executors share. What the labels lost is reported there too: labels that no column
    takes, expressions with several labels, and the number of response lines that could not be read. With
    `all_labels_needed` a label without a column ends the job before the wide table is built.
    """
    write_parquet(star_of(inputs), f"{out}/studies")
    flags = written(flags_of(inputs, sample_n, seed), f"{out}/flags")
    categorised = written(categorised_baselines(inputs), f"{out}/baselines")
    icd = written(icd_of(inputs), f"{out}/icd")
    write_csv(null_pattern_report(categorised), f"{out}/null_patterns")
    write_csv(keyword_counts(flags), f"{out}/flag_counts")
    write_csv(trial_matches(flags), f"{out}/flag_matches")
    given = inputs.labels if inputs.responses is None else inputs.responses
    write_csv(label_conflicts(given), f"{out}/label_conflicts")
    if inputs.responses is not None:
        write_csv(inputs.responses.groupBy("is_bad").agg(F.count(F.lit(1)).alias("lines")), f"{out}/response_lines")
    unplaced = written(unplaced_labels_of(categorised, inputs.labels), f"{out}/unplaced_labels")
    if all_labels_needed and not unplaced.isEmpty():
        raise ValueError(f"labels without a column, see {out}/unplaced_labels")
    wide = wide_table(
        base_of(inputs),
        inputs.countries,
        inputs.census,
        trial_flags_of(inputs, sample_n, seed),
        inputs.interventions,
        inputs.sponsors,
        icd,
        categorised,
        inputs.labels,
        keep=lambda df, name: written(df, f"{out}/{name}"),
    )
    wide = written(wide, f"{out}/trials")
    write_csv(wide, f"{out}/trials_csv")
    return wide
