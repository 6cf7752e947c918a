"""Preparation of raw tables for modelling, on Spark."""

import sys

from pyspark import cloudpickle

from tidyforge.operators.clean import (TableCleaner, clean_numeric, clean_strings, clean_text,
                                       drop_columns, map_categories_regex)
from tidyforge.operators.dedupe import deduplicate, sort_rows
from tidyforge.operators.encode import (OneHotEncoder, encode_categorical, one_hot_sparse,
                                        one_hot_vector)
from tidyforge.operators.features import (FeatureEngineer, binarize, custom_row_logic, date_parts,
                                          engineer_features, log_transform,
                                          polynomial_interaction, quantile_binning)
from tidyforge.operators.format import ModelFormatter, format_for_ml
from tidyforge.operators.impute import (MissingValueImputer, impute_missing, missing_percent,
                                        missingness_report)
from tidyforge.operators.merge import merge, resolve_collisions
from tidyforge.operators.scale import NumericScaler, scale_numeric
from tidyforge.operators.tune import HyperparameterTuner, hyper_parameter_tuner
from tidyforge.operators.udf import apply_custom_function
from tidyforge.operators.units import normalize_units, unconverted_units
from tidyforge.plans.prepare import (PIPELINE_PARAMETER_TEMPLATE, merge_datasets,
                                     parameter_template, process_data, process_data_from_config)
from tidyforge.plans.report import StageReport
from tidyforge.session import apply_settings, local_session, materialize
from tidyforge.sources.decode import decode_content, decode_files
from tidyforge.sources.discover import auto_prepare_merges, directory_crawler, find_files
from tidyforge.sources.html import extract_html_tables
from tidyforge.sources.load import load, load_data
from tidyforge.sources.save import save_output

# Functions sent to Python workers carry their code along, so that executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
