"""Record preparation with state fitted on training rows only.

``fit`` learns a few small tables from the training rows; ``features`` applies
them to any rows, training or new, through the same expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import PRIORITY_TAGS
from ..functions import latex, numeric, text
from ..operators import models, profile, symbols, tags, tfidf, validation
from ..operators.joins import apply_translations
from ..session import cut_lineage

LATEX_NUMBERS = ["nb_latex_blocks", "nb_latex_symbols", "latex_density", "latex_symbols_density"]
BASE_NUMBERS = ["difficulty", "time_limit_seconds"]
LENGTHS = ["char_length", "word_count", "numeric_ratio", "latex_ratio"]
TEXTS = ["description", "input_spec", "output_spec", "notes"]


@dataclass
class Options:
    """Names of the record columns and sizes of the fitted state."""

    key: str = "p_id"
    tags: str = "tags"
    description: str = "description"
    input_spec: str | None = "input_spec"
    output_spec: str | None = "output_spec"
    notes: str = "notes"
    sample_inputs: str | None = "sample_inputs"
    sample_outputs: str | None = "sample_outputs"
    time_limit: str = "time_limit"
    difficulty: str = "difficulty"
    labels: list[str] = field(default_factory=lambda: list(PRIORITY_TAGS))
    max_features: int = 5000
    ngrams: tuple[int, int] = (1, 2)
    min_df: int = 2
    max_df: float = 0.95
    top_symbols: int = 30
    min_symbol_docs: int = 10
    translated: bool = False


#: Column names of the published record schema.
RECORD_OPTIONS = {
    "key": "src_uid", "description": "prob_desc_description", "input_spec": "prob_desc_input_spec",
    "output_spec": "prob_desc_output_spec", "notes": "prob_desc_notes", "sample_inputs": "prob_desc_sample_inputs",
    "sample_outputs": "prob_desc_sample_outputs", "time_limit": "prob_desc_time_limit",
}


def target_names(labels: list[str]) -> list[str]:
    return ["target_" + t.replace(" ", "_") for t in labels]


def with_targets(df: DataFrame, o: Options) -> DataFrame:
    return df.withColumn("tags_priority", tags.keep_tags(o.tags, o.labels)).select(
        "*", *tags.target_columns("tags_priority", o.labels))


def translate(df: DataFrame, translations: DataFrame, o: Options) -> DataFrame:
    """Add ``*_translated`` columns from a supplied translation table."""
    for column in (o.description, o.input_spec, o.output_spec, o.notes):
        if column and column in df.columns:
            df = apply_translations(df, column, translations, o.key)
    return df


def base_columns(df: DataFrame, o: Options) -> DataFrame:
    """Everything that needs no fitted state, in narrow projections."""
    validation_columns = set(df.columns)
    if o.description not in validation_columns:
        raise ValueError(f"the input has no column '{o.description}'")
    suffix = "_translated" if o.translated else ""

    def column(name: str | None, cast: str = "string"):
        return F.col(name) if name and name in validation_columns else F.lit(None).cast(cast)

    df = df.withColumn(o.notes, text.replace_patterns(column(o.notes)))

    def source(name: str | None):
        translated = f"{name}{suffix}"
        return F.col(translated) if suffix and translated in validation_columns else column(name)

    d = source(o.description)
    split = latex.split_text_latex(d)
    notes = source(o.notes) if suffix else F.col(o.notes)
    document = text.unified_document(
        d, source(o.input_spec), source(o.output_spec), notes, column(o.sample_inputs), column(o.sample_outputs))
    out = df.withColumns({
        "_text": d,
        "time_limit_seconds": numeric.parse_time_limit(column(o.time_limit)),
        "difficulty": numeric.sentinel_to_null(numeric.not_nan(column(o.difficulty, "double").cast("double"))),
        **{n: split[n] for n in ["clean_description", *LATEX_NUMBERS]},
        "char_length": text.char_length(d),
        "word_count": text.word_count(d),
        "numeric_ratio": text.numeric_ratio(d),
        "latex_ratio": split["latex_density"],
        "unified_document": document,
    })
    return out.withColumn("unified_document_without_latex", latex.latex_to_token(F.col("unified_document")))


@dataclass
class FittedState:
    """What training rows taught: all of it small, all of it stored."""

    options: Options
    symbols: list[str]
    fills: dict[str, float]
    scaler: dict[str, tuple[float, float]]
    vocabulary: DataFrame
    vocabulary_size: int

    @property
    def dense(self) -> list[str]:
        """The one dense column order used in training and scoring."""
        return LATEX_NUMBERS + [latex.feature_name(s) for s in self.symbols] + BASE_NUMBERS + LENGTHS

    def save(self, path: str) -> None:
        """Write the whole state to another folder."""
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.save_values(path)

    def save_values(self, path: str) -> None:
        meta = {"options": self.options.__dict__, "symbols": self.symbols, "fills": self.fills,
                "scaler": {k: list(v) for k, v in self.scaler.items()}, "size": self.vocabulary_size}
        row = self.vocabulary.sparkSession.createDataFrame([(json.dumps(meta),)], "meta string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedState":
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        options = Options(**{**meta["options"], "ngrams": tuple(meta["options"]["ngrams"])})
        return cls(options, meta["symbols"], meta["fills"], {k: tuple(v) for k, v in meta["scaler"].items()},
                   spark.read.parquet(f"{path}/vocabulary"), meta["size"])


def stored_base(df: DataFrame, o: Options, keep: list[str] = ()) -> DataFrame:
    """The derived columns fitting reads, written once to the checkpoint
    folder: several passes follow, and each would repeat the text work."""
    columns = [o.key, "_text", *LATEX_NUMBERS, *BASE_NUMBERS, *LENGTHS, "unified_document_without_latex", *keep]
    return cut_lineage(base_columns(df, o).select(*columns))


def fit(base: DataFrame, o: Options, state_path: str) -> FittedState:
    """Learn symbols, fill values, scaling and vocabulary from the base
    columns of the training rows; write the vocabulary to ``state_path`` so
    later jobs read it instead of refitting.

    Only bounded results reach the driver: at most ``top_symbols`` names and
    one number pair per dense column.
    """
    spark = base.sparkSession
    presence = symbols.symbol_presence(base, "_text", o.key)
    chosen = symbols.selected_list(symbols.select_symbols(presence, o.top_symbols, o.min_symbol_docs), o.top_symbols)
    fills = {r["column"]: r["value"] for r in profile.fill_statistics(base, BASE_NUMBERS).collect()}
    names = LATEX_NUMBERS + [latex.feature_name(s) for s in chosen] + BASE_NUMBERS + LENGTHS
    filled = dense_columns(base, chosen, fills)
    scaler = {r["column"]: (r["mean"], r["std"]) for r in tfidf.fit_scaler(filled, names).collect()}
    vocabulary = tfidf.with_index(tfidf.fit_vocabulary(
        base, "unified_document_without_latex", o.ngrams, o.min_df, o.max_df, o.max_features))
    vocabulary.write.mode("overwrite").parquet(f"{state_path}/vocabulary")
    stored = spark.read.parquet(f"{state_path}/vocabulary")
    state = FittedState(o, chosen, fills, scaler, stored, stored.count())
    state.save_values(state_path)
    return state


def dense_columns(base: DataFrame, chosen: list[str], fills: dict[str, float]) -> DataFrame:
    """Imputed dense features; symbols absent from the rows give 0."""
    flagged = base.select("*", *symbols.symbol_features("_text", chosen))
    return profile.fill_missing(flagged, {c: fills.get(c, 0.0) for c in BASE_NUMBERS})


def features(df: DataFrame, state: FittedState, embedding: str | None = None) -> DataFrame:
    """Rows with a ``features`` vector: TF-IDF, then the embedding if there is
    one, then the scaled dense columns."""
    return features_of_base(base_columns(df, state.options), state, embedding)


def features_of_base(base: DataFrame, state: FittedState, embedding: str | None = None) -> DataFrame:
    o = state.options
    dense = tfidf.apply_scaler(dense_columns(base, state.symbols, state.fills), state.scaler, state.dense)
    joined = tfidf.vectors(dense.drop("_text"), "unified_document_without_latex", state.vocabulary, max(1, state.vocabulary_size),
                           ngrams=o.ngrams)
    blocks = ["tfidf"]
    if embedding is not None:
        joined = joined.withColumn("_embedding", array_to_vector(embedding))
        blocks.append("_embedding")
    return models.assemble(joined, blocks + state.dense).drop("_embedding")


def feature_blocks(state: FittedState, embedding_size: int = 0) -> dict[str, tuple[int, int]]:
    v, e = state.vocabulary_size, embedding_size
    return {"tfidf": (0, v), "embedding": (v, v + e), "dense": (v + e, v + e + len(state.dense))}


def check_input(df: DataFrame, o: Options) -> None:
    validation.require_text(df, o.description)
