"""Vector lookup, distances, document means and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.models.embeddings import document_vectors, idf_weights
from paperloom.operators import grid as G, similarity as S
from paperloom.queries.registry import Tables, query
from paperloom.queries.texts import TOKENS_SQL, token_table
from paperloom.session import staged
from paperloom.sources.sinks import vector_lines

# Lines that a task should gather into documents.
LINES = 2_000_000


def vectors(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


_E = "CAST(e.embedding AS DOUBLE[])"
_Q = "CAST(q.embedding AS DOUBLE[])"
_COS = (
    f"list_sum([a[1] * a[2] FOR a IN list_zip({_E}, {_Q})]) / "
    f"(sqrt(list_sum([x * x FOR x IN {_E}])) * sqrt(list_sum([x * x FOR x IN {_Q}])))"
)


@query(f"""
SELECT e.vec_id AS doc_id, round(1 - {_COS}, 6) + 0 AS distance
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q""")
def cosine_to_query(t):
    table = vectors(t)
    far = S.distances(table, S.query_vector(table, 7))
    return far.select("doc_id", (F.round("distance", 6) + F.lit(0)).alias("distance"))


@query(f"""
SELECT e.vec_id AS doc_id, round({_COS}, 6) AS similarity
FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q
WHERE e.vec_id <> 7 ORDER BY {_COS} DESC, e.vec_id LIMIT 10""")
def nearest_docs(t):
    return S.nearest(vectors(t), 7, 10).withColumn("similarity", F.round("similarity", 6))


_EXACT = f"""
  SELECT * FROM (SELECT q.vec_id AS doc_id, e.vec_id AS neighbour, {_COS} AS similarity,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, e.vec_id) AS rank
    FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 10"""


@query(f"SELECT doc_id, CAST(rank AS INTEGER) AS rank, neighbour, round(similarity, 6) AS similarity FROM ({_EXACT})")
def nearest_exact(t):
    found = S.nearest_exact(vectors(t).filter("doc_id % 20 = 0"), vectors(t), 10)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("""
SELECT CAST(count(*) AS BIGINT) AS documents, CAST(count(*) * least(10, count(*) - 1) AS BIGINT) AS neighbours,
       CAST(count(*) FILTER (WHERE vec_id % 20 = 0) AS BIGINT) AS asked, true AS recalled, true AS exact FROM embeddings""")
def nearest_all(t):
    """Neighbours of all documents; of ids divisible by 20, at least nine in ten of the exact ones are among them."""
    found = staged(S.nearest_all(vectors(t), 10), "nearest")
    want = S.nearest_exact(vectors(t).filter("doc_id % 20 = 0"), vectors(t), 10).withColumnRenamed("similarity", "want")
    both = want.join(found, ["doc_id", "neighbour"], "left")
    recall = both.agg(F.countDistinct("doc_id").alias("asked"), (F.count("similarity") >= 0.9 * F.count("*")).alias("recalled"),
                      F.coalesce(F.max(F.abs(F.col("similarity") - F.col("want"))) < 1e-9, F.lit(False)).alias("exact"))
    return found.agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("neighbours")).select(
        "documents", "neighbours", *(recall.select(c).scalar().alias(c) for c in recall.columns))


@query("""
SELECT vec_id AS doc_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS value
FROM embeddings WHERE vec_id = 7""")
def vector_lookup(t):
    row = S.vector_of(vectors(t), 7)
    return row.select("doc_id", F.posexplode("vector").alias("pos", "value"))


@query("""
WITH lines AS (SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS word FROM lineitem),
cells AS (
  SELECT l_orderkey AS doc_id, generate_subscripts(embedding, 1) AS slot,
         CAST(unnest(embedding) AS DOUBLE) AS value
  FROM lines JOIN embeddings ON word = vec_id),
means AS (SELECT doc_id, slot, avg(value) AS value FROM cells GROUP BY doc_id, slot)
SELECT o_orderkey AS doc_id, round(sum(value), 6) + 0 AS total, round(max(value), 6) AS top
FROM orders LEFT JOIN means ON o_orderkey = doc_id GROUP BY o_orderkey""")
def mean_vectors(t):
    """Orders as documents, their parts as words, part numbers of the vector table as known words."""
    lines, orders = t.lineitem, t.orders
    tasks = -(-lines.count() // LINES)
    if tasks > t.spark.sparkContext.defaultParallelism:  # else Spark may merge shuffle partitions into tasks of any size
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    bags = lines.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.collect_list("l_partkey").alias("parts"))
    documents = orders.select(F.col("o_orderkey").alias("doc_id")).join(bags, "doc_id", "left").select(
        "doc_id", F.col("parts").cast("array<string>").alias("tokens"))
    words = t.embeddings.select(F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vector"))
    made = document_vectors(documents, words)
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)
    return made.select(
        "doc_id", (F.round(total, 6) + F.lit(0)).alias("total"), F.round(F.array_max("vector"), 6).alias("top")
    )


@query(f"""
SELECT word, round(ln(CAST((SELECT count(*) FROM documents) + 1 AS DOUBLE) / (count(*) + 1)), 6) AS weight
FROM (SELECT DISTINCT doc_id, unnest(tokens) AS word FROM ({TOKENS_SQL})) GROUP BY word""")
def word_weights(t):
    return idf_weights(token_table(t)).withColumn("weight", F.round("weight", 6))


@query("""
SELECT count(*) || chr(9) || max(len(embedding)) AS value FROM embeddings""")
def vector_export_header(t):
    lines = vector_lines(vectors(t))
    return lines.filter(F.col("part") == 0).select("value")


def points(t: Tables):
    return t.embeddings.select(
        F.col("vec_id").alias("doc_id"), F.col("embedding")[0].cast("double").alias("x"),
        F.col("embedding")[1].cast("double").alias("y"), F.col("label").alias("category"),
    )


def pixels_sql(width: int, height: int, keep: str = "TRUE") -> str:
    return f"""
  SELECT doc_id, category,
         CAST(least(floor((x - x0) / (x1 - x0) * {width}), {width - 1}) AS INTEGER) AS px,
         CAST(least(floor((y - y0) / (y1 - y0) * {height}), {height - 1}) AS INTEGER) AS py
  FROM points, (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM points WHERE {keep})
  WHERE {keep}"""


POINTS_SQL = """WITH points AS (
  SELECT vec_id AS doc_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
         label AS category FROM embeddings)"""
_TOP = ("category IN (SELECT category FROM points GROUP BY category "
        "ORDER BY count(*) DESC, category LIMIT 5)")


@query(f"{POINTS_SQL} SELECT px, py, count(*) AS cnt FROM ({pixels_sql(500, 500)}) GROUP BY px, py")
def grid_counts(t):
    return G.grid_counts(points(t))


@query(f"""{POINTS_SQL} SELECT px, py, category, count(*) AS cnt
FROM ({pixels_sql(20, 10, _TOP)}) GROUP BY px, py, category""")
def grid_by_category(t):
    return G.grid_by_category(points(t), top=5, width=20, height=10)


_SMALL = f"{POINTS_SQL}, cells AS (SELECT px, py, count(*) AS cnt FROM ({pixels_sql(20, 20)}) GROUP BY px, py)"


@query(f"{_SMALL} SELECT px, py, cnt, round(cume_dist() OVER (ORDER BY cnt), 6) AS shade FROM cells")
def grid_equalised(t):
    shaded = G.equalise(G.grid_counts(points(t), 20, 20))
    return shaded.withColumn("shade", F.round("shade", 6))


@query(f"""{_SMALL} SELECT px, py, cnt,
  round(CAST(cnt - (SELECT min(cnt) FROM cells) AS DOUBLE)
        / (SELECT max(cnt) - min(cnt) FROM cells), 6) AS shade FROM cells""")
def grid_linear(t):
    shaded = G.linear_shade(G.grid_counts(points(t), 20, 20))
    return shaded.withColumn("shade", F.round("shade", 6))


@query("SELECT p_name AS category, row_number() OVER (ORDER BY p_name) - 1 AS category_index "
       "FROM (SELECT DISTINCT p_name FROM part)")
def category_index(t):
    return G.category_index(t.part.withColumnRenamed("p_name", "category"))
