"""Queries over features, learning, scoring and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.operators import features as X
from callsift.operators import intents as I
from callsift.operators import learning as L
from callsift.operators import rules
from callsift.operators.calls import ID
from callsift.operators.ordering import MIXED_RANGE, mixed, number_rows
from callsift.plans import jobs
from callsift.sources import sinks
from catalog import views as V
from catalog.aggregates import SIZING_ORACLE
from catalog.filters_joins import REPORT_SQL, _mix, sizing_input
from catalog.intent_queries import _distance_ctes, distance_ctes, many_references, many_sql, move_pack, wide_letters, wide_sql
from catalog.registry import query
from catalog.sources_sinks import _STILL_SQL
from catalog.text_queries import FORMS, relpos_sql

# coefficients of a fixed model: two tabular features, then the references
WEIGHTS = [0.01, 0.5, *[((j % 5) - 2) * 0.9 for j in range(len(fv.MOVE_SENTENCES))]]
INTERCEPT = 0.1
EXTRACTION = jobs.Extraction(min_exchange=V.MIN_EXCHANGE, allowed_lang=V.ALLOWED_LANG)


def labelled_vectors(spark, d):
    from pyspark.ml.functions import array_to_vector

    return V.table(spark, d, "embeddings").select(
        "vec_id",
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        (F.col("label") >= 5).cast("int").alias("label"),
    )


def _numbered_slim(spark, d):
    return number_rows(rules.slim_sentences(V.utterances(spark, d)), ID, ["sntnce_ts"])


def _feature_ctes(said: str, distances: str | None = None, score: str | None = None) -> list[str]:
    """From numbered sentences to scored chunks.  ``distances``: CTEs that give ``x``; ``score``: of a row of ``feats``."""
    logistic = f"""1 / (1 + exp(-({INTERCEPT} + list_inner_product(
            list_concat([CAST(sntce_len AS DOUBLE), CAST(rel_pos_sntce AS DOUBLE)], intent),
            [{', '.join(f'{w!r}::DOUBLE' for w in WEIGHTS)}]))))"""
    return [
        f"""flagged AS (SELECT *, {V.MOVER_SQL} AS mover, {V.EXCLUDED_SQL} AS excluded,
            coalesce(lead({V.CANCEL_SQL}, 3) OVER (PARTITION BY call_convrstn_id ORDER BY sntnce_ts), FALSE) AS after3
            FROM {said})""",
        f"""kept AS (SELECT * FROM (SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM flagged
            WHERE mover AND NOT excluded AND NOT after3 AND call_convrstn_id NOT IN
            (SELECT call_convrstn_id FROM flagged WHERE mover AND after3)) WHERE text <> '')""",
        distances or distance_ctes("kept", move_pack(), "move", "x"),
        f"""feats AS (SELECT call_convrstn_id AS conv_id, chunk_id, length(text) AS sntce_len,
            {relpos_sql('text', fv.PATTERNS['movers'])} AS rel_pos_sntce,
            (SELECT list(dist ORDER BY j) FROM x WHERE x.call_convrstn_id = kept.call_convrstn_id AND x.chunk_id = kept.chunk_id) AS intent
            FROM kept)""",
        f"scored AS (SELECT *, {score or logistic} AS detection_score FROM feats)",
    ]


def _feature_sql(body: str, said: str = "un", ctes: list[str] | None = None, *more: str, **features) -> str:
    return V.with_ctes(ctes or ["un"], ", " + ", ".join([*more, *_feature_ctes(said, **features)]) + " " + body)


_ENCODER = {"column_encoder": I.letter_counts}
_SCORER = jobs.weights_scorer(WEIGHTS, INTERCEPT)


@query(
    "m1_chunk_features",
    V.with_ctes(
        ["un"],
        f""", kept AS (SELECT * FROM (SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un
            WHERE sntnce_partcpnt_role = 'END_USER') WHERE text <> ''), {distance_ctes('kept', move_pack(), 'move', 'x')}
        SELECT kept.call_convrstn_id AS conv_id, kept.chunk_id, length(text) AS sntce_len,
        round({relpos_sql('text', fv.PATTERNS['movers'])}, 6) AS rel_pos_sntce, j, round(dist, 6) AS dist
        FROM kept JOIN x USING (call_convrstn_id, chunk_id)""",
    ),
)
def m1(spark, d):
    found = X.chunk_features(X.customer_chunks(V.numbered(spark, d)), move_pack(), **_ENCODER)
    return found.select(
        "conv_id",
        "chunk_id",
        "sntce_len",
        F.round("rel_pos_sntce", 6).alias("rel_pos_sntce"),
        F.posexplode("intent").alias("j", "dist"),
    ).withColumn("dist", F.round("dist", 6))


@query(
    "m2_conversation_features",
    _feature_sql(
        "SELECT conv_id, chunk_id, sntce_len, round(rel_pos_sntce, 6) AS rel_pos_sntce, "
        "round(list_sum(intent), 5) AS total FROM feats"
    ),
)
def m2(spark, d):
    found = X.conversation_features(_numbered_slim(spark, d), move_pack(), **_ENCODER)
    return found.select(
        "conv_id",
        "chunk_id",
        "sntce_len",
        F.round("rel_pos_sntce", 6).alias("rel_pos_sntce"),
        F.round(F.aggregate("intent", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


@query(
    "m3_feature_matrix",
    _feature_sql(
        "SELECT conv_id, chunk_id, k, round(list_concat([CAST(sntce_len AS DOUBLE), CAST(rel_pos_sntce AS DOUBLE)], intent)[k + 1], 6) AS value "
        f"FROM feats, (SELECT unnest(range({len(WEIGHTS)})) AS k)"
    ),
)
def m3(spark, d):
    from pyspark.ml.functions import vector_to_array

    found = X.conversation_features(_numbered_slim(spark, d), move_pack(), **_ENCODER)
    matrix = X.assemble(found, len(fv.MOVE_SENTENCES))
    return matrix.select(
        "conv_id", "chunk_id", F.posexplode(vector_to_array("features")).alias("k", "value")
    ).withColumn("value", F.round("value", 6))


NAMES = [f"v{i}" for i in range(64)]
_EACH_NAME = f"SELECT unnest({V.sql_list(NAMES)}) AS feature, TRUE AS at_optimum"


def _gradient(model, rows):
    """Of the stated objective, mean loss plus half the squared weights by C n, for each weight: zero at the optimum."""
    from pyspark.ml.functions import vector_to_array

    n = rows.count()
    miss = F.col("detection_score") - F.col("label")
    each = model.predict(rows).select(F.posexplode(vector_to_array("features")).alias("at", "x"), miss.alias("miss"))
    return each.groupBy("at").agg((F.sum(F.col("x") * F.col("miss")) / n).alias("loss")).join(
        rows.sparkSession.createDataFrame(
            [(i, f, float(w) / (model.params["C"] * n)) for i, (f, w) in enumerate(zip(NAMES, model.model.coefficients, strict=True))],
            "at int, feature string, penalty double",
        ),
        "at",
    ).select("feature", (F.abs(F.col("loss") + F.col("penalty")) < 1e-3).alias("at_optimum"))


@query("m4_logistic_fit", _EACH_NAME)
def m4(spark, d):
    rows = labelled_vectors(spark, d)
    return _gradient(L.LogisticClassifier(NAMES).fit(rows), rows)


@query("m5_predictions", "SELECT vec_id, TRUE AS as_stated FROM embeddings")
def m5(spark, d):
    """The probability is that of the coefficients as a plain expression, the class that of the probability."""
    from pyspark.ml.functions import vector_to_array

    rows = labelled_vectors(spark, d)
    model = L.LogisticClassifier(NAMES).fit(rows)
    plain = L.logistic_score(vector_to_array("features"), list(model.model.coefficients), model.model.intercept)
    found = model.predict(rows)
    same = F.abs(F.col("detection_score") - plain) < 1e-9
    return found.select("vec_id", (same & ((F.col("prediction") == 1) == (F.col("detection_score") > 0.5))).alias("as_stated"))


@query(
    "m5_fixed_weights",
    _feature_sql("SELECT conv_id, chunk_id, round(detection_score, 6) AS detection_score FROM scored"),
)
def m5_fixed(spark, d):
    found = X.conversation_features(_numbered_slim(spark, d), move_pack(), **_ENCODER)
    return _SCORER(found).select(
        "conv_id", "chunk_id", F.round("detection_score", 6).alias("detection_score")
    )


def _halves(spark, d):
    rows = labelled_vectors(spark, d)
    return X.split_rows(rows, 0.15, mixed(F.col("vec_id")), MIXED_RANGE, ["vec_id"])


def _shown_log(log, chosen: str):
    """Names of the fits, whether their accuracies can be ones, and whether the chosen one is the first of the best."""
    share = lambda c: F.col(c).between(0.0, 1.0)
    rows = log.collect()  # a row for each point of the grid
    first = max(range(len(rows)), key=lambda i: (rows[i]["test_accuracy"], -i))
    right = rows[first]["params"] == chosen
    return log.select("params", (share("train_accuracy") & share("test_accuracy")).alias("valid"), F.lit(right).alias("first_best"))


def _log_sql(names) -> str:
    return f"SELECT unnest({V.sql_list(names)}) AS params, TRUE AS valid, TRUE AS first_best"


@query("m6_grid_search", _log_sql([L.parameter_name(p) for p in L.parameter_grid()]))
def m6(spark, d):
    train, test = _halves(spark, d)
    model, log = L.fit_best(train, test, NAMES)
    return _shown_log(log, L.parameter_name({k: model.params[k] for k in fv.LR_GRID}))


@query("m7_single_fit", _log_sql([L.parameter_name(fv.LR_PARAMS)]))
def m7(spark, d):
    train, test = _halves(spark, d)
    model, log = L.fit_best(train, test, NAMES, grid=None)
    return _shown_log(log, L.parameter_name(model.params))


@query(
    "m8_boosted_trees",
    f"""SELECT feature, TRUE AS sums_to_one, TRUE AS beats_majority FROM (SELECT unnest({V.sql_list(NAMES)}) AS feature)""",
)
def m8(spark, d):
    rows = labelled_vectors(spark, d)
    model = L.BoostedTrees(NAMES).fit(rows)
    importance = model.importance(rows)
    total = importance.agg(F.sum("importance")).first()[0]
    shares = [r["n"] for r in L.class_counts(rows, "label").collect()]
    right = L.accuracy(model.predict(rows), "label", "prediction").first()[0]
    return importance.select(
        "feature", F.lit(abs(total - 1) < 1e-6).alias("sums_to_one"), F.lit(right >= max(shares) / sum(shares)).alias("beats_majority")
    )


_LEMMA_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORMS.items())
_WORDS_SQL = (
    r"list_transform(list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+'), "
    f"lambda t: length(t) > 0 AND NOT list_contains({V.sql_list(fv.FILLER_WORDS)}, t)), "
    f"lambda t: CASE t {_LEMMA_CASES} ELSE t END)"
)
_TRAIN_SQL = f"""WITH src AS (SELECT doc_id, quality, text FROM documents JOIN labels USING (doc_id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {_mix('doc_id')}, doc_id) AS r FROM src),
    equal AS (SELECT * FROM ranked WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM src GROUP BY quality))),
    cut AS (SELECT *, row_number() OVER (ORDER BY {_mix('doc_id')}, doc_id) AS q, count(*) OVER () AS n FROM equal)
    SELECT doc_id, CASE WHEN q <= ceil(n * CAST(0.3 AS DOUBLE)) THEN 'test' ELSE 'train' END AS part, quality AS y,
    {V.join_sql(_WORDS_SQL, ' ')} AS x FROM cut"""


@query("m9_training_text", _TRAIN_SQL)
def m9(spark, d):
    rows = V.table(spark, d, "documents").join(V.table(spark, d, "labels"), "doc_id")
    _, train, test = X.build_training_data(
        rows.select("doc_id", "text", "quality"),
        "text",
        "quality",
        mixed(F.col("doc_id")),
        MIXED_RANGE,
        ["doc_id"],
        fv.FILLER_WORDS,
        None,
        FORMS,
    )
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


_DETECTED = """SELECT conv_id, round(max(detection_score), 6) AS detection_score FROM scored
    WHERE detection_score > 0.5 AND conv_id NOT IN
    (SELECT call_convrstn_id FROM {said} WHERE chunk_id < 10 AND {cancel}) GROUP BY 1"""


@query("m12_classifier_detection", _feature_sql(_DETECTED.format(said="un", cancel=V.CANCEL_SQL)))
def m12(spark, d):
    found = jobs.detect_classified(V.utterances(spark, d), move_pack(), _SCORER, **_ENCODER)
    return found.withColumn("detection_score", F.round("detection_score", 6))


_NAIVE = f"SELECT call_convrstn_id AS conv_id, 1.0::DOUBLE AS detection_score FROM u WHERE {V.NAIVE_SQL} GROUP BY 1"


@query("m13_naive_detection", _NAIVE, ["u"])
def m13(spark, d):
    return jobs.detect_naive(V.utterances(spark, d))


@query(
    "m14_batch_detection",
    f"""SELECT conv_id, detection_score, n_total, n_found FROM ({_NAIVE}), (SELECT
        count(DISTINCT call_convrstn_id) AS n_total,
        count(DISTINCT CASE WHEN {V.NAIVE_SQL} THEN call_convrstn_id END) AS n_found FROM u)""",
    ["u"],
)
def m14(spark, d):
    """Detections of all conversations, and the statistics of the run next to each."""
    from callsift.session import shared_path

    found, rate = jobs.detect_all(
        V.utterances(spark, d), jobs.detect_naive, backup=shared_path(spark, "backup")
    )
    # the statistics are one row
    seen = rate.first()
    return found.select(
        "conv_id", "detection_score", F.lit(seen["n_total"]).alias("n_total"), F.lit(seen["n_detected"]).alias("n_found")
    )


_HELD_OUT = 300_000  # of MIXED_RANGE


@query(
    "m15_text_network",
    f"""SELECT call_convrstn_id, sntnce_ts, {_mix('CAST(call_convrstn_id AS BIGINT)')} < {_HELD_OUT} AS held_out, TRUE AS is_class,
        TRUE AS tells_apart FROM u""",
    ["u"],
)
def m15(spark, d):
    """The network learns movers' utterances in some conversations and tells them apart in the others."""
    rows = V.utterances(spark, d).select(
        ID,
        "sntnce_ts",
        F.col("sntnce").alias("text"),
        rules.mover_candidate(F.col("sntnce"), F.col("sntnce_partcpnt_role")).cast("double").alias("label"),
        (mixed(F.col(ID)) < _HELD_OUT).alias("held_out"),
    )
    model = L.text_classifier().fit(rows.filter(~F.col("held_out")))
    found = L.predict_text(model, rows)
    valid = F.col("prediction").isin(0.0, 1.0) & F.col("detection_score").between(0.0, 1.0)
    score = lambda label: F.avg(F.when(F.col("label") == label, F.col("detection_score")))
    apart = found.filter("held_out").agg((score(1) > score(0) + 0.25).alias("tells_apart"))
    return found.select(ID, "sntnce_ts", "held_out", valid.alias("is_class")).join(F.broadcast(apart))


# --- jobs -----------------------------------------------------------------------------------


@query(
    "p1_extract_conversations",
    """SELECT call_convrstn_id, CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date, bus_bacct_num_src_id,
       bus_bacct_num, virtualqueues, agnt_id, telephone, topics, pr_name FROM convs
       WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM es)""",
    ["convs", "es"],
)
def p1_conversations(spark, d):
    convs, _ = jobs.extract(V.calls(spark, d), V.FIRST_DAY, V.LAST_DAY, EXTRACTION)
    return convs.withColumn("call_convrstn_date", F.col("call_convrstn_date").cast("string"))


@query(
    "p1_extract_sentences",
    """SELECT call_convrstn_id, sntnce, sntnce_ts, sntnce_partcpnt_role, round(sntnce_sntmnt, 6) AS sntnce_sntmnt
       FROM es WHERE call_convrstn_id IN (SELECT call_convrstn_id FROM convs)""",
    ["convs", "es"],
)
def p1_sentences(spark, d):
    _, said = jobs.extract(V.calls(spark, d), V.FIRST_DAY, V.LAST_DAY, EXTRACTION)
    return said.withColumn("sntnce_sntmnt", F.round("sntnce_sntmnt", 6))


def _loaded_sql(detected: str) -> str:
    return f"""SELECT call_convrstn_id AS convrstn_id, CAST(call_convrstn_date AS VARCHAR) AS call_date,
        bus_bacct_num AS ban, CASE WHEN bus_bacct_num_src_id <> 0 THEN bus_bacct_num_src_id END AS src_id,
        telephone, 'moves' AS topic, CAST(round_even(detection_score, 3) AS DOUBLE) AS detection_score
        FROM convs JOIN ({detected}) ON conv_id = call_convrstn_id"""


def _shown(rows):
    return rows.withColumn("call_date", F.col("call_date").cast("string")).drop("gcp_refresh_date")


@query(
    "p2_naive_daily",
    _loaded_sql(
        f"SELECT call_convrstn_id AS conv_id, 1.0::DOUBLE AS detection_score FROM es WHERE {V.NAIVE_SQL} GROUP BY 1"
    ),
    ["convs", "es"],
)
def p2(spark, d):
    return _shown(jobs.naive_daily(V.calls(spark, d), V.FIRST_DAY, V.LAST_DAY, EXTRACTION))


_P3 = (
    _loaded_sql(
        _DETECTED.format(said="en", cancel=V.CANCEL_SQL).replace("round(max(detection_score), 6)", "max(detection_score)")
    ),
    "en",
    ["convs", "es"],
    "en AS (SELECT *, row_number() OVER (PARTITION BY call_convrstn_id ORDER BY sntnce_ts) - 1 AS chunk_id FROM es)",
)


def _nearness(features):
    """A score from the distances alone: 1 at a reference, 0.4 at a right angle to all."""
    return features.withColumn("detection_score", 1 - 0.6 * F.array_min("intent"))


@query(
    "p3_many_references",
    _feature_sql(*_P3, distances=_distance_ctes("kept", wide_sql("s"), many_sql(), "x"), score="1 - 0.6 * list_min(intent)"),
)
def p3_many(spark, d):
    """The daily classifier job with a reference of width 384 for each part."""
    pack = many_references(spark, d)
    return _shown(jobs.classifier_daily(V.calls(spark, d), V.FIRST_DAY, V.LAST_DAY, pack, _nearness, EXTRACTION, batch_encoder=wide_letters))


@query(
    "p3_classifier_daily",
    _feature_sql(*_P3),
)
def p3(spark, d):
    return _shown(
        jobs.classifier_daily(
            V.calls(spark, d),
            V.FIRST_DAY,
            V.LAST_DAY,
            move_pack(),
            _SCORER,
            EXTRACTION,
            **_ENCODER,
        )
    )


@query(
    "p4_label_examples",
    f"""SELECT call_convrstn_id, chunk_id, text FROM ({_STILL_SQL}) WHERE call_convrstn_id IN (
        SELECT call_convrstn_id FROM (SELECT DISTINCT call_convrstn_id FROM ({_STILL_SQL}))
        ORDER BY {_mix('CAST(call_convrstn_id AS BIGINT)')}, call_convrstn_id LIMIT 50)""",
    ["un"],
)
def p4(spark, d):
    found = jobs.label_examples(V.utterances(spark, d), 50, hash_column=mixed(F.col(ID)))
    return sinks.example_rows(found)


def _once_sql(rows: str) -> str:
    return f"""SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY convrstn_id ORDER BY call_date DESC NULLS LAST,
        src_id NULLS LAST, ban NULLS LAST, telephone NULLS LAST) AS place FROM ({rows})) WHERE place = 1"""


def _loaded(spark, load):
    """Run a loading job twice; the table is as after the first time."""
    from callsift.session import shared_path
    from catalog.sources_sinks import _located

    name, place = _located(spark, "loaded"), shared_path(spark, "table")
    for _ in range(2):
        load(name, place)
    return sinks.stored(spark, name)


@query(
    "p2_loaded",
    V.with_ctes(
        ["convs", "es"],
        _once_sql(
            _loaded_sql(
                f"SELECT call_convrstn_id AS conv_id, 1.0::DOUBLE AS detection_score FROM es WHERE {V.NAIVE_SQL} GROUP BY 1"
            )
        ),
    ),
)
def p2_loaded(spark, d):
    calls = V.calls(spark, d)
    return _shown(
        _loaded(
            spark,
            lambda name, place: jobs.load_naive_daily(
                spark, calls, V.FIRST_DAY, V.LAST_DAY, name, place, settings=EXTRACTION
            ),
        )
    )


@query(
    "p3_loaded",
    _feature_sql(
        _once_sql(
            _loaded_sql(
                _DETECTED.format(said="en", cancel=V.CANCEL_SQL).replace(
                    "round(max(detection_score), 6)", "max(detection_score)"
                )
            )
        ),
        "en",
        ["convs", "es"],
        "en AS (SELECT *, row_number() OVER (PARTITION BY call_convrstn_id ORDER BY sntnce_ts) - 1 AS chunk_id FROM es)",
    ),
)
def p3_loaded(spark, d):
    calls = V.calls(spark, d)
    return _shown(
        _loaded(
            spark,
            lambda name, place: jobs.load_classifier_daily(
                spark, calls, V.FIRST_DAY, V.LAST_DAY, move_pack(), _SCORER, name, place, settings=EXTRACTION, **_ENCODER
            ),
        )
    )


@query(
    "p4_loaded",
    f"""SELECT call_convrstn_id, chunk_id, text FROM ({_STILL_SQL}) WHERE call_convrstn_id IN (
        SELECT call_convrstn_id FROM (SELECT DISTINCT call_convrstn_id FROM ({_STILL_SQL}))
        ORDER BY {_mix('CAST(call_convrstn_id AS BIGINT)')}, call_convrstn_id LIMIT 50)""",
    ["un"],
)
def p4_loaded(spark, d):
    said = V.utterances(spark, d)
    return _loaded(
        spark,
        lambda name, place: jobs.load_examples_daily(
            spark, said, name, place, nb_select=50, hash_column=mixed(F.col(ID))
        ),
    )


def _annotated(spark, d):
    return V.numbered(spark, d).select(
        F.col(ID).alias("conv_id"),
        "chunk_id",
        "sntnce",
        F.when(F.length("sntnce") > 20, "Y").otherwise("N").alias("label"),
        F.col("sntnce_ts").alias("row_ord"),
    )


@query(
    "p5_training",
    V.with_ctes(
        ["un"],
        f""", kept AS (SELECT CASE WHEN length(sntnce) > 20 THEN 1 ELSE 0 END AS label, {V.clean_sql('sntnce')} AS text
            FROM un WHERE {V.MOVER_SQL} AND NOT {V.EXCLUDED_SQL})
        SELECT count(*) AS stored_rows, CAST(ceil(count(*) * CAST(0.15 AS DOUBLE)) AS BIGINT) AS test_rows, sum(label)::BIGINT AS moves,
        {len(L.parameter_grid())} AS logged, 0 AS changed FROM kept WHERE text <> ''""",
    ),
)
def p5(spark, d):
    """Annotated utterances, their features, the whole grid, and what is stored of it."""
    from callsift.session import shared_path
    from callsift.sources import readers

    found = jobs.training_features(_annotated(spark, d), "row_ord", move_pack(), **_ENCODER)
    folder = shared_path(spark, "training")
    model = jobs.train_and_store(found, len(fv.MOVE_SENTENCES), folder)
    data = readers.read_table(spark, f"{folder}/data")
    logged = spark.read.json(f"{folder}/log").count()
    again = jobs.load_classifier(model.feature_names, f"{folder}/model").predict(data)
    first = model.predict(data).select("conv_id", "chunk_id", F.col("prediction").alias("first"))
    return again.join(first, ["conv_id", "chunk_id"]).agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.count(F.when(F.col("part") == "test", 1)).alias("test_rows"),
        F.sum("label").cast("long").alias("moves"),
        F.lit(logged).cast("int").alias("logged"),
        F.count(F.when(F.col("first") != F.col("prediction"), 1)).cast("int").alias("changed"),
    )


@query(
    "p6_match_report",
    f"""SELECT call_convrstn_id, chunk_id, text, mover_match, cancel_match, bus_bacct_num,
        CAST(call_convrstn_date AS VARCHAR) AS call_convrstn_date
        FROM ({REPORT_SQL}) LEFT JOIN facts USING (call_convrstn_id)""",
    ["un", "facts"],
)
def p6_matches(spark, d):
    convs = V.conversation_facts(spark, d).withColumns(
        {
            "pr_name": F.lit(None).cast("string"),
            "iss_max": F.lit(None).cast("double"),
            "num": F.lit(None).cast("string"),
        }
    )
    found = jobs.kpi_report(convs, V.utterances(spark, d))["matches"]
    return found.select(
        ID,
        "chunk_id",
        "text",
        "mover_match",
        "cancel_match",
        "bus_bacct_num",
        F.col("call_convrstn_date").cast("string").alias("call_convrstn_date"),
    )


@query(
    "p6_sizing_report",
    SIZING_ORACLE,
    ["u"],
)
def p6_sizing(spark, d):
    convs = sizing_input(spark, d).withColumns(
        {"bus_bacct_num": F.lit(None).cast("string"), "call_convrstn_date": F.lit(None).cast("date")}
    )
    return jobs.kpi_report(convs, V.utterances(spark, d))["sizing"]


