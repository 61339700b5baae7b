"""What a user runs: extraction, detection, sampling, training, sizing
(P1-P6, M12-M14)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.regex import any_match
from callsift.operators import calls as C
from callsift.operators import features as X
from callsift.operators import learning as L
from callsift.operators import reports as R
from callsift.operators import rules
from callsift.operators.intents import Pack as Intents
from callsift.operators.ordering import number_rows
from callsift.session import stage, stages_of_its_own
from callsift.sources import sinks
from callsift.sources.sinks import detection_rows

ID = C.ID


@dataclass(frozen=True)
class Extraction:
    """Settings of the extraction."""

    min_exchange: int = 2
    allowed_lang: str = "en-us"
    number: str = "telephone"
    area_codes: Mapping[str, str] = field(default_factory=lambda: fv.AREA_CODES)
    columns: tuple[str, ...] = (
        ID,
        "call_convrstn_date",
        "bus_bacct_num_src_id",
        "bus_bacct_num",
        "virtualqueues",
        "agnt_id",
        "telephone",
        "topics",
        "pr_name",
    )


# a scorer adds ``detection_score`` to feature rows
Scorer = Callable[[DataFrame], DataFrame]


def conversation_facts(
    calls: DataFrame,
    settings: Extraction,
    only: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The conversation table, of some ids if they are given."""
    found = C.conversations(calls, only, keep)
    found = C.with_province(found, settings.number, settings.area_codes)
    return C.pick(found, [*settings.columns, *keep])


def extract(
    calls: DataFrame, lo, hi, settings: Extraction = Extraction(), places: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(conversations, sentences), each with a counterpart in the other.

    With ``places`` sentences carry their place in the record, by which detection
    and sampling then order those of one time.
    """
    day = C.calls_between(calls, lo, hi)
    said = C.sentences(day, (*C.SENTENCE_FIELDS, C.PLACE) if places else tuple(C.SENTENCE_FIELDS))
    heads = C.sentences(day, C.SAID_BY_WHOM)
    ids = C.eligible_ids(heads, settings.min_exchange, settings.allowed_lang)
    # whether a conversation has facts shows in its labels and issues alone
    known = C.known_identity(C.call_attributes(day)).select(ID)
    convs = conversation_facts(day, settings).join(ids, ID, "left_semi")
    return convs, C.eligible_sentences(said, ids.join(known, ID, "left_semi"))


def detect_naive(said: DataFrame, pack: rules.Pack = fv.PATTERNS) -> DataFrame:
    """Conversations with a naive match, all at score 1."""
    hits = rules.naive_matches(said, pack).select(
        F.col(ID).alias("conv_id"), F.lit(1.0).alias("detection_score")
    )
    return rules.best_scores(hits)


def with_facts(detected: DataFrame, convs: DataFrame, other_ids=fv.OTHER_ID_COLUMNS) -> DataFrame:
    """Detections with the ids and the date of their call."""
    columns = [d["name"] for d in other_ids] + [ID, "call_convrstn_date"]
    facts = convs.select(*columns)
    return detected.join(facts, detected["conv_id"] == facts[ID], "left").drop(ID)


def naive_daily(
    calls: DataFrame,
    lo,
    hi,
    settings: Extraction = Extraction(),
    pack: rules.Pack = fv.PATTERNS,
    refresh_date: Column | None = None,
) -> DataFrame:
    """Rows for the detection table.

    The rule is decided in the pass that measures eligibility, so of each
    sentence only a flag leaves the map task.  Facts are gathered for the
    calls of detected conversations alone.
    """
    day = C.calls_between(calls, lo, hi)
    said = C.sentences(day, C.SAID_BY_WHOM)
    rule = rules.naive_rule(F.col("sntnce"), F.col("sntnce_partcpnt_role"), pack)
    profile = C.role_profile(said, hit=F.max(rule))
    hits = (
        C.eligible(
            profile, settings.min_exchange, settings.allowed_lang, hit=F.max("hit")
        )
        .filter("hit")
        .select(ID, F.lit(1.0).alias("detection_score"))
    )
    return _load_rows(day, hits, settings, refresh_date)


def _load_rows(day, detected, settings, refresh_date):
    """Rows of the detected conversations that have facts."""
    rows = conversation_facts(day, settings, detected, keep=["detection_score"])
    return detection_rows(rows.withColumnRenamed(ID, "conv_id"), refresh_date)


def classifier_scorer(model: L.Classifier, n_intents: int) -> Scorer:
    return lambda features: model.predict(X.assemble(features, n_intents))


def weights_scorer(weights: Sequence[float], intercept: float) -> Scorer:
    return lambda features: X.feature_array(features).withColumn(
        "detection_score", L.logistic_score(F.col("features"), weights, intercept)
    )


def _classified(
    slim: DataFrame,
    pack: Intents,
    scorer: Scorer,
    patterns: rules.Pack,
    mode: str,
    large_keys: bool,
    **encoder,
) -> DataFrame:
    numbered = rules.notable(
        number_rows(slim, ID, C.spoken_order(slim), large_keys=large_keys)
    )
    features = X.conversation_features(numbered, pack, patterns, mode=mode, **encoder)
    # the best score passes the threshold if any does; asking it last keeps the
    # costly score out of a filter, where it would be computed again
    best = rules.above_threshold(rules.best_scores(scorer(features)))
    early = rules.early_among(numbered).withColumnRenamed(ID, "conv_id")
    return rules.without(best, early, "conv_id")


def detect_classified(
    said: DataFrame,
    pack: Intents,
    scorer: Scorer,
    patterns: rules.Pack = fv.PATTERNS,
    mode: str = "after",
    large_keys: bool = False,
    **encoder,
) -> DataFrame:
    """Conversations above the threshold, with their best score.

    ``large_keys`` as in ``number_rows``.
    """
    return _classified(
        rules.slim_sentences(said, patterns), pack, scorer, patterns, mode, large_keys, **encoder
    )


def classifier_daily(
    calls: DataFrame,
    lo,
    hi,
    pack: Intents,
    scorer: Scorer,
    settings: Extraction = Extraction(),
    patterns: rules.Pack = fv.PATTERNS,
    mode: str = "after",
    refresh_date: Column | None = None,
    large_keys: bool = False,
    **encoder,
) -> DataFrame:
    """Rows for the detection table.

    One pass finds the eligible conversations that have a candidate at all;
    only their sentences are numbered, and only candidates bring their text.
    """
    day = C.calls_between(calls, lo, hi)
    said = C.sentences(day, (*C.SAID_WHEN, C.PLACE))
    candidate = rules.mover_candidate(F.col("sntnce"), F.col("sntnce_partcpnt_role"), patterns)
    profile = C.role_profile(C.sentences(day, C.SAID_BY_WHOM), hit=F.max(candidate))
    ids = stage(
        C.eligible(
            profile,
            settings.min_exchange,
            settings.allowed_lang,
            hit=F.max("hit"),
        )
        .filter("hit")
        .select(ID)
    )
    slim = rules.slim_sentences(said, patterns).join(ids, ID, "left_semi")
    detected = _classified(slim, pack, scorer, patterns, mode, large_keys, **encoder)
    return _load_rows(day, detected.withColumnRenamed("conv_id", ID), settings, refresh_date)


def detect_all(
    said: DataFrame, detect: Callable[[DataFrame], DataFrame], backup: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(detections, A15 statistics) of all conversations in one job.

    With ``backup`` the detections are stored first and read back.
    """
    found = detect(said)
    if backup is not None:
        found.write.mode("overwrite").parquet(backup)
        found = said.sparkSession.read.parquet(backup)
    ids = found.select(F.col("conv_id").alias(ID))
    return found, R.detection_rate(said, ids)


def union_days(parts: Sequence[DataFrame]) -> DataFrame:
    """O3: results of several days, side by side."""
    if not parts:
        raise ValueError("nothing to unite")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def label_matches(said: DataFrame, pack: rules.Pack = fv.PATTERNS) -> DataFrame:
    """P4 before the draw: customer chunks that match before and after cleaning."""
    everything = rules.flatten(pack)
    keep = rules.is_customer(F.col("sntnce_partcpnt_role")) & any_match(F.col("sntnce"), everything)
    chunks = X.customer_chunks(rules.number_kept(said, keep))
    return rules.non_empty(chunks, "text").filter(
        any_match(F.col("text"), everything, gate=False)
    )


def label_examples(
    said: DataFrame,
    nb_select: int = fv.NB_SELECT,
    pack: rules.Pack = fv.PATTERNS,
    hash_column: Column | None = None,
) -> DataFrame:
    """Examples to label, from ``nb_select`` conversations in hash order."""
    order = hash_column if hash_column is not None else F.xxhash64(ID)
    # the draw and its conversations both come from the matches
    return rules.sample_conversations(stage(label_matches(said, pack)), nb_select, order)


def training_features(
    annotations: DataFrame,
    row_order: str,
    pack: Intents,
    patterns: rules.Pack = fv.PATTERNS,
    **encoder,
) -> DataFrame:
    """P5, first half: features of annotated chunks, with their label."""
    said, labels = X.clean_annotations(annotations, row_order)
    slim = rules.slim_sentences(said, patterns, keep=["chunk_id"])
    return X.conversation_features(slim, pack, patterns, labels, mode=None, **encoder)


def train(
    features: DataFrame,
    n_intents: int,
    ratio: float = fv.TEST_RATIO_FEATURES,
    grid: Mapping[str, Sequence] | None = fv.LR_GRID,
    **params,
) -> tuple[L.LogisticClassifier, DataFrame, DataFrame, DataFrame]:
    """P5, second half: (classifier, log, train rows, test rows)."""
    rows = X.assemble(features, n_intents)
    order = F.pmod(F.xxhash64("conv_id", "chunk_id"), F.lit(2**31 - 1))
    # staged: the split, the fits and what is stored read the features, which cost most
    first, second = X.split_rows(rows, ratio, order, 2**31 - 1, ["conv_id", "chunk_id"], staged=True)
    model, log = L.fit_best(first, second, X.feature_names(n_intents), grid, **params)
    return model, log, first, second


def load_naive_daily(spark, calls: DataFrame, lo, hi, table: str, location: str | None = None, **settings) -> None:
    """P2 to its end: the day's detections are in the table.  Running it again changes nothing.

    What a loading job has staged for itself is deleted when it ends.
    """
    with stages_of_its_own(spark):
        rows = sinks.one_per_conversation(naive_daily(calls, lo, hi, **settings))
        sinks.load_detections(spark, table, rows, location)


def load_classifier_daily(
    spark, calls: DataFrame, lo, hi, pack: Intents, scorer: Scorer, table: str, location: str | None = None, **settings
) -> None:
    """P3 to its end, as above."""
    with stages_of_its_own(spark):
        rows = sinks.one_per_conversation(classifier_daily(calls, lo, hi, pack, scorer, **settings))
        sinks.load_detections(spark, table, rows, location)


def load_examples_daily(spark, said: DataFrame, table: str, location: str | None = None, **settings) -> None:
    """P4 to its end: the drawn examples are in the table."""
    with stages_of_its_own(spark):
        sinks.load_examples(spark, table, sinks.one_per_place(label_examples(said, **settings)), location)


def train_and_store(features: DataFrame, n_intents: int, folder: str, **settings) -> L.LogisticClassifier:
    """P5 to its end: grid, refit, and model, data and log stored in ``folder``.  Returns the model as reloaded."""
    with stages_of_its_own(features.sparkSession):
        model, log, first, second = train(features, n_intents, **settings)
        sinks.save_model(model.model, f"{folder}/model")
        sinks.save_data(first, second, f"{folder}/data")
        sinks.save_log(log, f"{folder}/log")
        return load_classifier(model.feature_names, f"{folder}/model")


def load_classifier(feature_names: Sequence[str], path: str) -> L.LogisticClassifier:
    from pyspark.ml.classification import LogisticRegressionModel

    found = L.LogisticClassifier(feature_names)
    found.model = sinks.load_model(LogisticRegressionModel, path)
    return found


def kpi_report(
    convs: DataFrame, said: DataFrame, pack: rules.Pack = fv.PATTERNS
) -> dict[str, DataFrame]:
    """Sizing, sentence statistics, matches and matches per date."""
    keep = rules.mover_candidate(F.col("sntnce"), F.col("sntnce_partcpnt_role"), pack)
    report = R.match_report(rules.number_kept(said, keep), pack)
    matches = R.with_call_facts(report, convs)
    return {
        "sizing": R.sizing(convs, said),
        "sentences": R.describe(R.sentence_counts(said), "sntnce"),
        "matches": matches,
        "per_date": R.per_date(matches),
    }


__all__ = [
    "Extraction",
    "classifier_daily",
    "classifier_scorer",
    "detect_all",
    "detect_classified",
    "detect_naive",
    "extract",
    "kpi_report",
    "label_examples",
    "load_classifier",
    "load_classifier_daily",
    "load_examples_daily",
    "load_naive_daily",
    "naive_daily",
    "train",
    "train_and_store",
    "training_features",
    "union_days",
    "weights_scorer",
    "with_facts",
]
