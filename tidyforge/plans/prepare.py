"""The full preparation run and its stages."""

from __future__ import annotations

from copy import deepcopy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyforge.functions.names import present, ref
from tidyforge.functions.text import apply_string_options
from tidyforge.operators.clean import DEFAULT_OPTIONS, TableCleaner, clean_text
from tidyforge.operators.dedupe import deduplicate
from tidyforge.operators.features import FeatureEngineer
from tidyforge.operators.format import ENCODE_EXCLUSIONS, SCALE_EXCLUSIONS, ModelFormatter
from tidyforge.operators.impute import Strategy, fit_imputation
from tidyforge.operators.merge import filter_equal, keys_as_text, merge
from tidyforge.operators.units import normalize_units
from tidyforge.plans.report import StageReport
from tidyforge.session import apply_settings, materialize
from tidyforge.sources.discover import auto_prepare_merges
from tidyforge.sources.load import SOURCE_ORDER, load, load_data
from tidyforge.sources.save import save_output, saved
from pyspark.sql import types as T

# The configuration keys of a run and their defaults.
PIPELINE_PARAMETER_TEMPLATE = {
    "dir_path": None,
    "file_extension": ".csv",
    "name_pattern": None,
    "on_keys": ["SEQN"],
    "how": "left",
    "primary_file": None,
    "output_file": "processed_output.csv",
    "load_kwargs": {},
    "clean_columns": None,
    "clean_options": dict(DEFAULT_OPTIONS),
    "drop_columns": [],
    "merge_configs": [],
    "dedupe_subset": None,
    "dedupe_keep": "first",
    "dedupe_sort_by": None,
    "dedupe_sort_ascending": True,
    "lab_configs": [],
    "drop_threshold": 50.0,
    "impute_strategies": [],
    "feature_steps": [],
    "encode_categorical": True,
    "encoding": "columns",
    "max_categories": None,
    "exclude_encode_prefixes": ENCODE_EXCLUSIONS,
    "scale_method": "standard",
    "exclude_scale_cols": [],
    "default_scale_exclusions": list(SCALE_EXCLUSIONS),
}
CONVERTED = "__converted_"
DISCOVERY_KEYS = ("dir_path", "file_extension", "name_pattern", "on_keys", "how")


def label_cleaner(options: dict | None):
    """The cleaning of text columns, applied to a literal such as a filter value."""
    chosen = DEFAULT_OPTIONS if options is None else options

    def clean(text: Column) -> Column:
        return apply_string_options(text, T.StringType(), chosen)

    return clean


def merge_datasets(df: DataFrame, merge_configs: list[dict] | None = None,
                   clean_options: dict | None = None, loader=load, merger=merge,
                   cleaner=TableCleaner, report: StageReport | None = None) -> DataFrame:
    """Merge supplemental tables one after the other, in the given order.

    Each config has ``file`` (path, view text or DataFrame), ``on``, and optionally
    ``how``, ``filters``, ``collapse_duplicates``, ``collision``, ``order_by``, ``key_filter``,
    ``clean_options`` and ``load_kwargs``.  Incoming tables are cleaned with the same
    options as the primary one, so that keys and filter values meet.
    """
    for number, config in enumerate(merge_configs or [], 1):
        source = config["file"]
        collapse = config.get("collapse_duplicates", True)
        options = config.get("clean_options", clean_options)
        in_file_order = collapse and not config.get("order_by")
        if isinstance(source, DataFrame):
            new = source
        else:
            extra = {"source_order": True} if in_file_order and loader is load else {}
            new = loader(df.sparkSession, source, **extra, **config.get("load_kwargs", {}))
        order = config.get("order_by") or ([SOURCE_ORDER] if SOURCE_ORDER in new.columns else None)
        new = clean_text(new, options=options, cleaner=cleaner)
        renamed = new.withColumnRenamed(SOURCE_ORDER, "__new_order")
        if report:
            # Of the incoming table alone, whose scan reads no more than these columns.
            keys = present(new, [config["on"]] if isinstance(config["on"], str) else config["on"])
            kept = filter_equal(new, config.get("filters"), label_cleaner(options))
            report.watch(new, f"merge {number} input")
            distinct = {"keys": F.count_distinct(F.struct(*map(ref, keys)))} if collapse and keys else {}
            report.watch(kept, f"merge {number} filtered", **distinct)
        order = ["__new_order" if c == SOURCE_ORDER else c for c in order] if order else None
        if number > 1 and config.get("how", "left") in ("right", "outer"):
            # These joins read the base twice; a chain of them must not double each time.
            df = materialize(df, "merged")
        df = merger(df, renamed, on=config["on"], how=config.get("how", "left"),
                    filters=config.get("filters"), collapse_duplicates=collapse,
                    collision=config.get("collision", "keep_base"), order_by=order,
                    **({"key_filter": True} if config.get("key_filter") else {}),
                    clean_filter=label_cleaner(options), text_keys=False).drop("__new_order")
        # A left merge with collapse keeps the row count, so there is nothing to count.
        if report and not (collapse and config.get("how", "left") == "left"):
            report.watch(df, f"merge {number}")
    return keys_as_text(df, present(df, merge_keys(merge_configs)))


def merge_keys(merge_configs: list[dict] | None) -> list[str]:
    """All key names of the merge rules, each once."""
    listed = [[c["on"]] if isinstance(c["on"], str) else c["on"] for c in merge_configs or []]
    return list(dict.fromkeys(k for keys in listed for k in keys))


def process_data(spark: SparkSession, primary_file: str | DataFrame, output_file: str | None = None,
                 load_kwargs: dict | None = None, clean_columns: list | None = None,
                 clean_options: dict | None = None, drop_columns: list | None = None,
                 merge_configs: list | None = None, dedupe_subset: list | None = None,
                 dedupe_keep: str | bool = "first", dedupe_sort_by: list | None = None,
                 dedupe_sort_ascending: bool = True, lab_configs: list | None = None,
                 drop_threshold: float | None = 50.0, impute_strategies: list | None = None,
                 feature_steps: list | None = None, encode_categorical: bool = True,
                 exclude_encode_prefixes: tuple = ENCODE_EXCLUSIONS,
                 scale_method: str | None = "standard", exclude_scale_cols: list | None = None,
                 default_scale_exclusions: list | None = None, scale_dummies: bool = False,
                 report: StageReport | None = None, encoding: str = "columns",
                 max_categories: int | None = None) -> DataFrame:
    """Load, clean, merge, deduplicate, unify units, impute, derive, encode, scale, save.

    Loading up to units is one lazy plan without a job.  Its result is written to the
    shared folder once, because the later stages learn from it in several passes; each
    pass then reads only the columns it needs.
    """
    apply_settings(spark)
    # Row order of the files matters only where "first" or "last" is left to it.
    file_order = bool(dedupe_subset) and not dedupe_sort_by and dedupe_keep is not False
    if isinstance(primary_file, DataFrame):
        df = primary_file
    else:
        df = load_data(spark, primary_file, source_order=file_order, **(load_kwargs or {}))
    if report:
        report.watch(df, "load")
    df = clean_text(df, clean_columns, clean_options, drop_columns)
    df = merge_datasets(df, merge_configs, clean_options, report=report)

    sort_by = [SOURCE_ORDER] if file_order and SOURCE_ORDER in df.columns else dedupe_sort_by
    df = deduplicate(df, dedupe_subset, dedupe_keep, sort_by, dedupe_sort_ascending)
    df = normalize_units(df.drop(SOURCE_ORDER), lab_configs, label_cleaner(clean_options),
                         mark=CONVERTED if report else None)
    df = materialize(df, "prepared")
    if report:
        # Counted on the written table, so that no join runs again.
        marks = [c for c in df.columns if c.startswith(CONVERTED)]
        report.watch(df, "deduplicate")
        if marks:
            report.watch(df, "units", **{f"converted_{c[len(CONVERTED):]}": F.count_if(ref(c))
                                         for c in marks})
        df = df.drop(*marks)

    rules = [Strategy(s.get("method", "mean"), s.get("cols", []), s.get("constant_val"))
             for s in impute_strategies or []]
    plan = fit_imputation(df, drop_threshold, rules)
    df = plan.apply(df)
    if report:
        report.note("impute", "dropped_columns", len(plan.drop_columns))
    if feature_steps:
        df = FeatureEngineer(feature_steps).fit(df).transform(df)

    keys = merge_keys(merge_configs)
    formatter = ModelFormatter(
        encode_categorical, exclude_encode_prefixes, scale_method, exclude_scale_cols,
        default_scale_exclusions, keys=present(df, [*keys, *(dedupe_subset or [])]),
        scale_dummies=scale_dummies, max_categories=max_categories, encoding=encoding)
    df = formatter.fit(df).transform(df)
    if output_file:
        save_output(df, output_file)
        if report:
            report.watch(saved(spark, output_file), "save")
    return df


def process_data_from_config(spark: SparkSession, config: dict,
                             report: StageReport | None = None) -> DataFrame:
    """Run from one dict; unknown keys are errors.

    With ``dir_path`` the files found there become merge rules in front of the listed
    ones; the primary file itself is left out.
    """
    if not isinstance(config, dict):
        raise TypeError("config must be a dict of run parameters")
    if config.get("primary_file") is None or config["primary_file"] == "":
        raise ValueError("config must name a primary_file")
    unknown = sorted(set(config) - set(PIPELINE_PARAMETER_TEMPLATE))
    if unknown:
        raise ValueError(f"unknown config key(s): {unknown}")
    settings = {k: v for k, v in config.items() if k not in DISCOVERY_KEYS}
    if config.get("dir_path"):
        defaults = PIPELINE_PARAMETER_TEMPLATE
        primary = config["primary_file"]
        found = auto_prepare_merges(
            spark, config["dir_path"], config.get("file_extension", defaults["file_extension"]),
            config.get("on_keys", defaults["on_keys"]), config.get("how", "left"),
            config.get("name_pattern"), exclude=[primary] if isinstance(primary, str) else [])
        settings["merge_configs"] = found + list(config.get("merge_configs") or [])
    return process_data(spark, report=report, **settings)


def parameter_template() -> dict:
    """A fresh copy of the configuration template."""
    return deepcopy(PIPELINE_PARAMETER_TEMPLATE)
