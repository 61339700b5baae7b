"""Queries over intent distances."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.vectors import cosine_distance
from callsift.operators import features as X
from callsift.operators import intents as I
from callsift.operators.calls import ID
from catalog import views as V
from catalog.registry import query

KEYS = ["doc_id", "chunk_idx"]


def _long(wide, intent_columns):
    """(chunk, intent, j, value) rows from one array column per intent."""
    named = F.array(
        *[
            F.struct(F.lit(i).alias("intent"), F.col(c).alias("values"))
            for i, c in intent_columns.items()
        ]
    )
    return wide.select(*KEYS, F.inline(named)).select(
        *KEYS, "intent", F.posexplode("values").alias("j", "value")
    )


_LEAST = """SELECT s.doc_id, s.chunk_idx, round(coalesce(min(p.dp), 1.0), 6) AS dist
    FROM scaffold s LEFT JOIN pairs p USING (doc_id, chunk_idx) GROUP BY ALL"""


def _scored(spark, d, pack, name="d"):
    return I.with_distances(V.vectors(spark, d), "vec", {name: pack})


@query("a7_least_distance", _LEAST, ["scaffold", "pairs"])
def a7(spark, d):
    scored = _scored(spark, d, V.one_pack(spark, d))
    found = I.min_distance(scored, KEYS, "d_all", V.chunk_list(spark, d))
    return found.withColumn("dist", F.round("dist", 6))


_ALL = """SELECT s.doc_id, s.chunk_idx, r.j, round(coalesce(min(p.dp), 1.0), 6) AS dist
    FROM (SELECT * FROM scaffold, (SELECT j FROM refs) r) s
    JOIN refs r ON r.j = s.j LEFT JOIN pairs p ON p.doc_id = s.doc_id AND p.chunk_idx = s.chunk_idx AND p.j = s.j
    GROUP BY ALL"""


def _all(spark, d):
    pack = V.one_pack(spark, d)
    scored = _scored(spark, d, pack)
    found = I.all_distances(scored, KEYS, "d_all", pack.sizes()["all"], V.chunk_list(spark, d))
    return found.select(*KEYS, F.posexplode("dists").alias("j", "dist")).withColumn(
        "dist", F.round("dist", 6)
    )


@query("a8_all_distances", _ALL, ["scaffold", "pairs", "refs"])
def a8(spark, d):
    return _all(spark, d)


@query("j11_sentences_by_references", "SELECT vec_id, j, round(dp, 6) AS dist FROM pairs", ["pairs"])
def j11(spark, d):
    scored = _scored(spark, d, V.one_pack(spark, d))
    return scored.select("vec_id", F.posexplode("d_all").alias("j", "dist")).withColumn(
        "dist", F.round("dist", 6)
    )


@query(
    "i2_cosine_distance",
    "SELECT vec_id, round(list_cosine_distance(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 6) AS dist FROM embeddings",
)
def i2(spark, d):
    rows = V.table(spark, d, "embeddings")
    return rows.select(
        "vec_id",
        F.round(cosine_distance(F.col("embedding"), F.reverse("embedding")), 6).alias("dist"),
    )


@query(
    "i2_references_in_blocks",
    _LEAST,
    ["scaffold", "pairs"],
)
def i2_blocks(spark, d):
    """The way for reference tables of any size."""
    refs = V.references(spark, d).select("j", F.col("pos").alias("vec"))
    scored = I.least_distances(V.vectors(spark, d), "vec", refs).withColumn("dists", F.array("dist"))
    found = I.min_distance(scored, KEYS, "dists", V.chunk_list(spark, d))
    return found.withColumn("dist", F.round("dist", 6))


_PER_INTENT = "SELECT j, intent, row_number() OVER (PARTITION BY intent ORDER BY j) - 1 AS k FROM refs"


@query(
    "i5_several_intents_least",
    """SELECT s.doc_id, s.chunk_idx, s.intent, round(coalesce(min(p.dp), 1.0), 6) AS dist
       FROM (SELECT * FROM scaffold, (SELECT DISTINCT intent FROM refs)) s
       LEFT JOIN pairs p USING (doc_id, chunk_idx, intent) GROUP BY ALL""",
    ["scaffold", "pairs", "refs"],
)
def i5(spark, d):
    pack = V.several_packs(spark, d)
    scored = _scored(spark, d, pack)
    found = I.min_distances_by_intent(scored, KEYS, "d", pack, V.chunk_list(spark, d))
    named = F.array(
        *[F.struct(F.lit(i).alias("intent"), F.col(i).alias("dist")) for i in pack.vectors]
    )
    return found.select(*KEYS, F.inline(named)).withColumn("dist", F.round("dist", 6))


@query(
    "i6_several_intents_all",
    f"""SELECT s.doc_id, s.chunk_idx, s.intent, s.k AS j, round(coalesce(min(p.dp), 1.0), 6) AS value
       FROM (SELECT * FROM scaffold, ({_PER_INTENT})) s
       LEFT JOIN pairs p ON p.doc_id = s.doc_id AND p.chunk_idx = s.chunk_idx AND p.j = s.j GROUP BY ALL""",
    ["scaffold", "pairs", "refs"],
)
def i6(spark, d):
    pack = V.several_packs(spark, d)
    scored = _scored(spark, d, pack)
    found = I.all_distances_by_intent(scored, KEYS, "d", pack, V.chunk_list(spark, d))
    return _long(found, {i: i for i in pack.vectors}).withColumn("value", F.round("value", 6))


def _opposed_scored(spark, d, pack):
    sides = {"p": pack.positive, "n": pack.negative}
    return I.with_distances(V.vectors(spark, d), "vec", sides)


_OPPOSED_MIN = """SELECT s.doc_id, s.chunk_idx, {extra} round((1 + coalesce(min(p.dp), 1.0) - coalesce(min(p.dn), 1.0)) / 2, 6) AS score
    FROM {scaffold} s LEFT JOIN pairs p USING ({keys}) GROUP BY ALL"""


@query(
    "i7_opposed_least",
    _OPPOSED_MIN.format(extra="", scaffold="scaffold", keys="doc_id, chunk_idx"),
    ["scaffold", "pairs"],
)
def i7(spark, d):
    pack = I.OpposedPack(V.one_pack(spark, d, "pos"), V.one_pack(spark, d, "neg"))
    found = I.opposed_by_intent(_opposed_scored(spark, d, pack), KEYS, pack, V.chunk_list(spark, d), "min")
    return found.select(*KEYS, F.round("all", 6).alias("score"))


@query(
    "i8_opposed_all",
    """SELECT s.doc_id, s.chunk_idx, s.j, round((1 + coalesce(min(p.dp), 1.0) - coalesce(min(p.dn), 1.0)) / 2, 6) AS score
       FROM (SELECT * FROM scaffold, (SELECT j FROM refs)) s
       LEFT JOIN pairs p ON p.doc_id = s.doc_id AND p.chunk_idx = s.chunk_idx AND p.j = s.j GROUP BY ALL""",
    ["scaffold", "pairs", "refs"],
)
def i8(spark, d):
    pack = I.OpposedPack(V.one_pack(spark, d, "pos"), V.one_pack(spark, d, "neg"))
    found = I.opposed_by_intent(_opposed_scored(spark, d, pack), KEYS, pack, V.chunk_list(spark, d), "all")
    return found.select(*KEYS, F.posexplode("all").alias("j", "score")).withColumn(
        "score", F.round("score", 6)
    )


@query(
    "i9_several_opposed_least",
    _OPPOSED_MIN.format(
        extra="s.intent,",
        scaffold="(SELECT * FROM scaffold, (SELECT DISTINCT intent FROM refs))",
        keys="doc_id, chunk_idx, intent",
    ),
    ["scaffold", "pairs", "refs"],
)
def i9(spark, d):
    pack = I.OpposedPack(V.several_packs(spark, d, "pos"), V.several_packs(spark, d, "neg"))
    found = I.opposed_by_intent(_opposed_scored(spark, d, pack), KEYS, pack, V.chunk_list(spark, d), "min")
    named = F.array(*[F.struct(F.lit(i).alias("intent"), F.col(i).alias("score")) for i in pack.sizes()])
    return found.select(*KEYS, F.inline(named)).withColumn("score", F.round("score", 6))


@query(
    "i10_several_opposed_all",
    f"""SELECT s.doc_id, s.chunk_idx, s.intent, s.k AS j, round((1 + coalesce(min(p.dp), 1.0) - coalesce(min(p.dn), 1.0)) / 2, 6) AS value
       FROM (SELECT * FROM scaffold, ({_PER_INTENT})) s
       LEFT JOIN pairs p ON p.doc_id = s.doc_id AND p.chunk_idx = s.chunk_idx AND p.j = s.j GROUP BY ALL""",
    ["scaffold", "pairs", "refs"],
)
def i10(spark, d):
    pack = I.OpposedPack(V.several_packs(spark, d, "pos"), V.several_packs(spark, d, "neg"))
    found = I.opposed_by_intent(_opposed_scored(spark, d, pack), KEYS, pack, V.chunk_list(spark, d), "all")
    return _long(found, {i: i for i in pack.sizes()}).withColumn("value", F.round("value", 6))


# --- text, with the letter-count encoder -------------------------------------------------


def move_pack():
    return I.IntentPack.encode({"move": fv.MOVE_SENTENCES}, I.letter_count_matrix)


_PAIRS_OF_SENTENCES = [
    f"{a}/{b}" for a, b in zip(fv.MOVE_SENTENCES[:13], fv.MOVE_SENTENCES[13:], strict=True)
]


def letters_sql(text: str) -> str:
    return "[" + ", ".join(
        f"CAST(length(lower({text})) - length(replace(lower({text}), '{c}', '')) AS DOUBLE)"
        for c in "abcdefghijklmnopqrstuvwxyz"
    ) + "]"


def matrix_sql(pack, intent):
    return "[" + ", ".join(
        "[" + ", ".join(f"{x!r}::DOUBLE" for x in row) + "]" for row in pack.vectors[intent].tolist()
    ) + "]"


def distance_ctes(source: str, pack, intent: str, name: str) -> str:
    """CTEs that give (call id, chunk, j, dist) for the chunks of ``source``."""
    refs = f"SELECT unnest(range({len(pack.vectors[intent])})) AS j, unnest({matrix_sql(pack, intent)}) AS r"
    return _distance_ctes(source, letters_sql("s"), refs, name)


def _distance_ctes(source: str, vector: str, refs: str, name: str) -> str:
    """As above, with the vector of a sub-sentence ``s`` and the rows (j, r) of the references in SQL."""
    return f"""{name}_sub AS (SELECT call_convrstn_id, chunk_id, unnest(list_filter(string_split_regex(text, '(?:\\.|\\;|\\,)'),
        lambda s: length(s) > 5)) AS s FROM {source}),
    {name}_vec AS (SELECT call_convrstn_id, chunk_id, {vector} AS v FROM {name}_sub),
    {name}_ref AS ({refs}),
    {name}_pair AS (SELECT call_convrstn_id, chunk_id, j, CASE WHEN list_sum(v) > 0 AND list_sum(r) > 0
        THEN list_cosine_distance(v, r) ELSE 1.0 END AS dist FROM {name}_vec, {name}_ref),
    {name} AS (SELECT c.call_convrstn_id, c.chunk_id, r.j, coalesce(min(p.dist), 1.0) AS dist
        FROM {source} c CROSS JOIN {name}_ref r LEFT JOIN {name}_pair p
        ON p.call_convrstn_id = c.call_convrstn_id AND p.chunk_id = c.chunk_id AND p.j = r.j GROUP BY ALL)"""


_CHUNKS = f"chunks AS (SELECT call_convrstn_id, chunk_id, {V.clean_sql('sntnce')} AS text FROM un WHERE sntnce_partcpnt_role = 'END_USER')"


def _chunks(spark, d):
    return X.customer_chunks(V.numbered(spark, d))


def _sql(body: str, *ctes: str) -> str:
    """A body behind the shared table ``un`` and further ones."""
    return V.with_ctes(["un"], ", " + ", ".join(ctes) + " " + body)


def _letters(how):
    def run(spark, d):
        found = I.intent_distances(
            _chunks(spark, d), "text", move_pack(), how, column_encoder=I.letter_counts
        )
        if how == "min":
            return found.select(ID, "chunk_id", F.round("move", 6).alias("dist"))
        return found.select(ID, "chunk_id", F.posexplode("move").alias("j", "dist")).withColumn(
            "dist", F.round("dist", 6)
        )

    return run


query(
    "i3_single_intent_least",
    _sql(
        "SELECT call_convrstn_id, chunk_id, round(min(dist), 6) AS dist FROM x GROUP BY ALL",
        _CHUNKS,
        distance_ctes("chunks", move_pack(), "move", "x"),
    ),
)(_letters("min"))

query(
    "i4_single_intent_all",
    _sql(
        "SELECT call_convrstn_id, chunk_id, j, round(dist, 6) AS dist FROM x",
        _CHUNKS,
        distance_ctes("chunks", move_pack(), "move", "x"),
    ),
)(_letters("all"))


def _batch_letters():
    return I.letter_count_matrix


@query(
    "i11_intent_encoding",
    _sql(
        "SELECT call_convrstn_id, chunk_id, j, round(dist, 6) AS dist FROM x",
        _CHUNKS,
        distance_ctes("chunks", move_pack(), "move", "x"),
    ),
)
def i11(spark, d):
    """The same distances from a batch encoder in the Python workers."""
    found = I.intent_distances(
        _chunks(spark, d), "text", move_pack(), "all", batch_encoder=_batch_letters
    )
    return found.select(ID, "chunk_id", F.posexplode("move").alias("j", "dist")).withColumn(
        "dist", F.round("dist", 6)
    )


def _opposed_pack():
    return I.OpposedPack.encode(
        {"first": _PAIRS_OF_SENTENCES[:6], "second": _PAIRS_OF_SENTENCES[6:]}, I.letter_count_matrix
    )


@query(
    "i12_several_intent_encoding",
    _sql(
        """SELECT call_convrstn_id, chunk_id,
        round((1 + min(a.dist) - min(b.dist)) / 2, 6) AS first, round((1 + min(e.dist) - min(f.dist)) / 2, 6) AS second
        FROM p1 a JOIN n1 b USING (call_convrstn_id, chunk_id) JOIN p2 e USING (call_convrstn_id, chunk_id)
        JOIN n2 f USING (call_convrstn_id, chunk_id) GROUP BY ALL""",
        _CHUNKS,
        *[
            distance_ctes("chunks", side, intent, name)
            for name, side, intent in (
                ("p1", _opposed_pack().positive, "first"),
                ("n1", _opposed_pack().negative, "first"),
                ("p2", _opposed_pack().positive, "second"),
                ("n2", _opposed_pack().negative, "second"),
            )
        ],
    ),
)
def i12(spark, d):
    found = I.opposed_distances(
        _chunks(spark, d), "text", _opposed_pack(), "min", column_encoder=I.letter_counts
    )
    return found.select(
        ID, "chunk_id", F.round("first", 6).alias("first"), F.round("second", 6).alias("second")
    )


@query("i13_intent_sizes", "SELECT intent, count(*) AS n FROM refs GROUP BY 1", ["refs"])
def i13(spark, d):
    return V.references(spark, d).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i1_encoded_sentences",
    r"SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '\s+'), lambda t: t <> '')) AS DOUBLE) AS total FROM documents",
)
def i1(spark, d):
    docs = V.table(spark, d, "documents").select("doc_id", "text")
    return I.encode_hashed(docs, "text", 64).select(
        "doc_id", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 3).alias("total")
    )


@query(
    "i1_repeated_sentences",
    r"""SELECT doc_id, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda t: t <> '')) AS DOUBLE) AS total
    FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'said by many' ELSE text END AS text FROM documents)""",
)
def i1_repeated(spark, d):
    """A batch encoder over distinct texts, some of them missing and one of them said by a third of all."""
    text = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 0, F.lit("said by many")).otherwise(F.col("text"))
    rows = V.table(spark, d, "documents").select("doc_id", text.alias("text"))
    return I.encode_texts(rows, "text", I.hashed_words(64)).select(
        "doc_id", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 3).alias("total")
    )


_WIDE = "list_concat(" * 5 + "{0}" + "".join(f", {{{b}}})" for b in range(1, 6))


def _wide_sql(v: str) -> str:
    parts = [f"list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (({b} + {v}) % 7 - 3))" for b in range(6)]
    return _WIDE.format(*parts)


def _many_sql(variants: str) -> str:
    return f"""WITH r AS (SELECT vec_id, v, {_wide_sql('v')} AS vec FROM embeddings, (SELECT unnest([{variants}]) AS v)),
    q AS (SELECT vec_id, {_wide_sql('3')} AS vec FROM embeddings)
    SELECT q.vec_id, round(min(1 - list_cosine_similarity(q.vec, r.vec)), 6) AS least, count(*) AS n FROM q, r GROUP BY 1"""


@query("i2_many_references", _many_sql("3"))
def i2_many(spark, d):
    """Every embedding against all embeddings, at width 384: each finds itself."""
    return _least_of_many(V.table(spark, d, "embeddings"), [3])


@query("i2_all_many_references", _many_sql("0, 1, 2"))
def i2_all_many(spark, d):
    """Every embedding against three references of width 384 from each."""
    return _least_of_many(V.table(spark, d, "embeddings"), [0, 1, 2])


def _least_of_many(rows, variants):
    def wide(v):
        return F.concat(*[_scaled(b, v) for b in range(6)])

    references = rows.select("vec_id", "embedding", F.explode(F.array(*map(F.lit, variants))).alias("v"))
    references = references.select((F.col("vec_id") * 4 + F.col("v")).alias("j"), wide(F.col("v")).alias("vec"))
    found = I.least_distances(rows.select("vec_id", wide(F.lit(3)).alias("vec")), "vec", references)
    return found.select("vec_id", F.round("dist", 6).alias("least"), F.col("seen").alias("n"))


def _scaled(b: int, v):
    return F.transform("embedding", lambda x: x.cast("double") * ((F.lit(b) + v) % 7 - 3))


# --- text against thousands of references of width 384 -------------------------------------

_WIDE_LETTERS, _PLACES = "abcdefghijklmnopqrstuvwx", 16


def wide_letters():
    """A batch encoder of width 384: each of 24 letters counted by the place of its word, modulo 16."""

    def encode(texts):
        out = np.zeros((len(texts), _PLACES * len(_WIDE_LETTERS)))
        for i, text in enumerate(texts):
            words = text.lower().split(" ")
            for place in range(_PLACES):
                mine = " ".join(words[place::_PLACES])
                for k, letter in enumerate(_WIDE_LETTERS):
                    out[i, place * len(_WIDE_LETTERS) + k] = mine.count(letter)
        return out

    return encode


def wide_sql(text: str) -> str:
    letters = "[" + ", ".join(f"'{c}'" for c in _WIDE_LETTERS) + "]"
    counted = f"list_transform({letters}, lambda c: CAST(length(w) - length(replace(w, c, '')) AS DOUBLE))"
    words = f"string_split(lower({text}), ' ')"
    placed = f"list_transform(range({_PLACES}), lambda b: array_to_string(list_filter({words}, lambda w, i: (i - 1) % {_PLACES} = b), ' '))"
    return f"flatten(list_transform({placed}, lambda w: {counted}))"


_REFERENCE_TEXT = "lower(concat(p_name, ' ', p_type, ' please and ', p_brand, ' of ', p_name))"


def many_references(spark, d, intent="'move'", keep="true"):
    """A pack of a reference for each part, kept as a table."""
    parts = V.table(spark, d, "part").filter(keep).select("p_partkey", F.expr(intent).alias("intent"), F.expr(_REFERENCE_TEXT).alias("text"))
    return I.IntentPack.from_rows(I.encode_texts(parts, "text", wide_letters), "intent", "p_partkey", "vec")


def many_sql(keep: str = "true") -> str:
    return f"SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS j, {wide_sql(_REFERENCE_TEXT)} AS r FROM part WHERE {keep}"


_MANY = {"batch_encoder": wide_letters}

query(
    "i4_many_references",
    _sql(
        "SELECT call_convrstn_id, chunk_id, count(*) AS n, round(min(dist), 6) AS least, round(max(dist), 6) AS most, round(sum(dist), 4) AS total FROM x GROUP BY ALL",
        _CHUNKS,
        _distance_ctes("chunks", wide_sql("s"), many_sql(), "x"),
    ),
)(
    lambda spark, d: I.intent_distances(_chunks(spark, d), "text", many_references(spark, d), "all", **_MANY).select(
        ID,
        "chunk_id",
        F.size("move").cast("long").alias("n"),
        F.round(F.array_min("move"), 6).alias("least"),
        F.round(F.array_max("move"), 6).alias("most"),
        F.round(F.aggregate("move", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )
)

query(
    "i5_many_references",
    _sql(
        "SELECT call_convrstn_id, chunk_id, round(a.dist, 6) AS odd, round(b.dist, 6) AS even FROM "
        "(SELECT call_convrstn_id, chunk_id, min(dist) AS dist FROM o GROUP BY ALL) a JOIN (SELECT call_convrstn_id, chunk_id, min(dist) AS dist FROM e GROUP BY ALL) b USING (call_convrstn_id, chunk_id)",
        _CHUNKS,
        _distance_ctes("chunks", wide_sql("s"), many_sql("p_partkey % 2 = 1"), "o"),
        _distance_ctes("chunks", wide_sql("s"), many_sql("p_partkey % 2 = 0"), "e"),
    ),
)(
    lambda spark, d: I.intent_distances(
        _chunks(spark, d), "text", many_references(spark, d, "if(p_partkey % 2 = 1, 'odd', 'even')"), "min", **_MANY
    ).select(ID, "chunk_id", F.round("odd", 6).alias("odd"), F.round("even", 6).alias("even"))
)

query(
    "i7_many_references",
    _sql(
        "SELECT call_convrstn_id, chunk_id, round((1 + a.dist - b.dist) / 2, 6) AS score FROM "
        "(SELECT call_convrstn_id, chunk_id, min(dist) AS dist FROM o GROUP BY ALL) a JOIN (SELECT call_convrstn_id, chunk_id, min(dist) AS dist FROM e GROUP BY ALL) b USING (call_convrstn_id, chunk_id)",
        _CHUNKS,
        _distance_ctes("chunks", wide_sql("s"), many_sql("p_partkey % 2 = 1"), "o"),
        _distance_ctes("chunks", wide_sql("s"), many_sql("p_partkey % 2 = 0"), "e"),
    ),
)(
    lambda spark, d: I.opposed_distances(
        _chunks(spark, d),
        "text",
        I.OpposedPack(many_references(spark, d, keep="p_partkey % 2 = 1"), many_references(spark, d, keep="p_partkey % 2 = 0")),
        "min",
        **_MANY,
    ).select(ID, "chunk_id", F.round("move", 6).alias("score"))
)
