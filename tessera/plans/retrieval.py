"""Vectors, full text, chunks and event windows on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import vectors
from tessera.functions.conditions import link
from tessera.functions.text import fold
from tessera.operators import chunk, coverage, fulltext, search, vectorlists
from tessera.plans.registry import Plans
from tessera.scratch import shared_dir
from tessera.streaming import events, state

P = Plans()
query = P.query
_COS = "list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / (sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))))"
_round = lambda c: F.round(c, 6)


def _items(read):
    return read("embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _query_vector(read, i: int = 0) -> list[float]:
    return read("embeddings").filter(F.col("vec_id") == i).select("embedding").first()[0]


@query(f"SELECT b.vec_id AS id, round({_COS}, 6) AS cosine FROM embeddings a, embeddings b WHERE a.vec_id = 0 ORDER BY {_COS} DESC, b.vec_id LIMIT 15")
def nearest_vectors(read):
    """The nearest items of a query vector."""
    return search.by_cosine(_items(read), _query_vector(read), 15).select("id", _round("cosine").alias("cosine"))


@query(f"SELECT b.vec_id AS id, round({_COS}, 6) AS cosine FROM embeddings a, embeddings b WHERE a.vec_id = 3 AND b.label = (SELECT min(label) FROM embeddings) ORDER BY {_COS} DESC, b.vec_id LIMIT 15")
def nearest_with_filter(read):
    """A filter before the scoring."""
    items = _items(read)
    least = items.agg(F.min("label")).first()[0]
    return search.by_cosine(items.filter(F.col("label") == least), _query_vector(read, 3), 15).select("id", _round("cosine").alias("cosine"))


@query(f"SELECT query_id, id, round(cosine, 6) AS cosine, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, {_COS} AS cosine, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) AS INTEGER) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0) WHERE rank <= 10")
def nearest_of_many(read):
    """The nearest items of every fiftieth one, exactly."""
    items = _items(read)
    asked = items.filter("id % 50 = 0").select("id", "embedding")
    return search.by_cosine_many(items, asked, 10).select("query_id", "id", _round("cosine").alias("cosine"), "rank")


@query(f"SELECT query_id, id, round(cosine, 6) AS cosine, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, {_COS} AS cosine, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id) AS INTEGER) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0) WHERE rank <= 10")
def nearest_by_lists(read):
    """The same from inverted lists, whose bounds leave unread what cannot be nearer."""
    items = _items(read)
    index = vectorlists.Lists.build(items.select("id", "embedding"), 16)
    asked = items.filter("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    return index.nearest(asked, 10).select("query_id", "id", _round("cosine").alias("cosine"), "rank")


@query(f"SELECT id, cosine FROM (SELECT b.vec_id AS id, round({_COS}, 6) AS cosine, max({_COS}) OVER () AS best FROM embeddings a, embeddings b WHERE a.vec_id = 1 AND b.vec_id <> 1) WHERE best >= 0.6 AND cosine >= 0.3")
def gated_vectors(read):
    """All or none, by the best hit."""
    items = _items(read).filter("id <> 1")
    q = F.array(*[F.lit(float(x)) for x in _query_vector(read, 1)])
    return search.gate(items.select("id", vectors.cosine(F.col("embedding"), q).alias("cosine"))).select("id", _round("cosine").alias("cosine")).filter("cosine >= 0.3")


_MID = "list_transform(range(1, len(a.embedding) + 1), lambda i: CAST(a.embedding[i] AS DOUBLE) + CAST(b.embedding[i] AS DOUBLE))"


@query(f"""WITH q AS (SELECT a.vec_id AS query_id, {_MID} AS v FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 50 = 0 UNION ALL SELECT -1 - vec_id, list_transform(embedding, lambda x: -CAST(x AS DOUBLE)) FROM embeddings WHERE vec_id % 50 = 1),
s AS (SELECT query_id, e.vec_id AS id, list_dot_product(q.v, CAST(e.embedding AS DOUBLE[])) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))) AS c FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, id) AS k, max(c) OVER (PARTITION BY query_id) AS best FROM s) SELECT query_id, id, round(c, 6) AS cosine FROM r WHERE best >= 0.6 AND k <= 15""")
def gate_of_many(read):
    """Queries between two vectors reach the gate and keep their hits; turned vectors have no hit that does."""
    items = _items(read)
    v = items.select("id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    both = v.filter("id % 50 = 0").join(v.select((F.col("id") - 1).alias("id"), F.col("v").alias("w")), "id")
    turned = v.filter("id % 50 = 1").select((-1 - F.col("id")).alias("query_id"), F.transform("v", lambda x: -x).alias("query"))
    asked = both.select(F.col("id").alias("query_id"), F.zip_with("v", "w", lambda a, b: a + b).alias("query")).union(turned)
    hits = search.by_cosine_many(items, asked, search.FINAL)
    return search.gate(hits, group="query_id").select("query_id", "id", _round("cosine").alias("cosine"))


@query(f"SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * 127) AS TINYINT)) AS bytes FROM embeddings")
def quantised_units(read):
    """Unit vectors as signed bytes."""
    return read("embeddings").select("vec_id", vectors.quantise(vectors.normalise(F.col("embedding"))).alias("bytes"))


@query()
def greedy_vector_dedupe(read):
    """In order, what is like a kept item goes; a group is a label."""
    q = F.array(*[F.lit(float(x)) for x in _query_vector(read)])
    items = _items(read).withColumn("cosine", vectors.cosine(F.col("embedding"), q))
    return search.greedy_distinct(items, final=None, same=0.9, group="label").select("grp", "id", "rank", F.size("merged").alias("n_merged"))


@query("SELECT vec_id, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 100) AS INTEGER)) AS bytes FROM embeddings")
def quantised_vectors(read):
    """Vectors as small integers."""
    return read("embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 100).cast("int")).alias("bytes"))


_WORDS = r"list_filter(string_split(trim(regexp_replace(lower(regexp_replace(strip_accents(replace(text, 'ß', '')), '[^\x00-\x7F]', '', 'g')), '[^a-z0-9_]+', ' ', 'g')), ' '), lambda w: w <> '')"
_INDEX = f"words AS (SELECT doc_id, {_WORDS} AS w FROM documents), idx AS (SELECT doc_id, w[i] AS token, i AS pos, len(w) AS n FROM words, unnest(range(1, len(w) + 1)) AS r(i))"


def _index(read):
    """The written index of the documents; the queries on it read no text."""
    docs = read("documents")
    plain = F.regexp_replace(F.replace("text", F.lit("ß"), F.lit("")), r"[\[\]()]", " ")
    return fulltext.index_of(docs.select("doc_id", plain.alias("text")), docs.inputFiles()[0], "doc_id", "text")


@query(f"""WITH {_INDEX}, c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, avg(len(w)) FILTER (len(w) > 0) AS mean FROM words),
tf AS (SELECT doc_id, token, count(*) AS tf, any_value(n) AS n FROM idx WHERE token IN ('edthe', 'with', 'licensed') GROUP BY 1, 2), df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1)
SELECT doc_id AS id, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n / mean))), 6) AS score FROM tf JOIN df USING (token), c GROUP BY 1""")
def full_text_scores(read):
    """Documents with any of the words, by BM25."""
    return _index(read).scores(["edthe", "with", "licensed"]).select("id", _round("score").alias("score"))


@query(f"""WITH {_INDEX}, c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, avg(len(w)) FILTER (len(w) > 0) AS mean FROM words),
tf AS (SELECT doc_id, token, count(*) AS tf, any_value(n) AS n FROM idx WHERE token IN ('the', 'licensed', 'copyright') GROUP BY 1, 2), df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
s AS (SELECT doc_id, sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n / mean))) AS score FROM tf JOIN df USING (token), c GROUP BY 1)
SELECT doc_id AS id, round(score, 6) AS score FROM s ORDER BY s.score DESC, doc_id LIMIT 15""")
def full_text_best(read):
    """The best documents by BM25, from the blocks whose bounds reach them."""
    return _index(read).best(["the", "licensed", "copyright"], 15).select("id", _round("score").alias("score"))


@query(f"WITH {_INDEX} SELECT a.doc_id AS id, count(*) AS n FROM idx a JOIN idx b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.token = 'of' AND b.token = 'the' GROUP BY 1")
def phrase_matches(read):
    """Places where the words follow each other."""
    return _index(read).phrase(["of", "the"])


@query(f"WITH {_INDEX} SELECT (SELECT count(DISTINCT a.doc_id) FROM idx a JOIN idx b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.token = 'of' AND b.token = 'the') AS n_phrase, (SELECT count(DISTINCT doc_id) FROM idx WHERE token IN ('of', 'the')) AS n_any")
def phrase_against_words(read):
    """Documents with the phrase, and with any of its words."""
    return _index(read).phrase_against_words(["of", "the"])


@query(f"WITH {_INDEX} SELECT token, CAST(levenshtein(token, 'with') AS INTEGER) AS distance FROM (SELECT DISTINCT token FROM idx) WHERE levenshtein(token, 'with') <= 2")
def fuzzy_words(read):
    """Words of the index within an edit distance."""
    return _index(read).similar("with")


@query(f"""WITH {_INDEX}, bm AS (SELECT item_id, {_WORDS} AS w FROM benchmark), g AS (SELECT DISTINCT item_id, array_to_string(w[i:i+7], ' ') AS gram FROM bm, unnest(range(1, greatest(len(w) - 6, 1))) AS r(i) WHERE len(w) >= 8),
d AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+7], ' ') AS gram FROM words, unnest(range(1, greatest(len(w) - 6, 1))) AS r(i) WHERE len(w) >= 8) SELECT doc_id, item_id, count(*) AS n FROM d JOIN g USING (gram) GROUP BY 1, 2""")
def shared_ngrams(read):
    """Links between tables by n-grams of words."""

    def words(df, key):
        plain = F.regexp_replace(F.replace("text", F.lit("ß"), F.lit("")), r"[\[\]()]", " ")
        return df.select(key, F.filter(F.split(fold(plain), " "), lambda w: w != "").alias("w")).filter(F.size("w") >= 8)

    def hashed(df, key):
        return df.select(key, F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - 7), lambda i: F.xxhash64(F.slice("w", i, 8)))).alias("i", "h"))

    gram = F.array_join(F.slice("w", F.col("i") + 1, 8), " ")
    docs, items = words(read("documents"), "doc_id"), words(read("benchmark"), "item_id")
    known = hashed(items, "item_id").join(items, "item_id").select("item_id", "h", gram.alias("gram")).distinct()
    # Numbers meet first, and the sides' sizes decide how; the words of what met are compared.
    met = hashed(docs, "doc_id").join(known, "h").join(docs, "doc_id").filter(gram == F.col("gram"))
    return met.select("doc_id", "item_id", "gram").distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n"))


@query()
def condition_links(read):
    """Phrases linked through rewritings to a dictionary."""
    part = read("part")
    dictionary = part.select(fold(F.concat(F.element_at(F.split("p_name", " "), 2), F.lit("s, "), F.element_at(F.split("p_name", " "), 1))).alias("probe"), F.concat(F.lit("D:"), "p_name").alias("key")).distinct()
    terms = part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("chronic "), "p_name", F.lit("s")).alias("term"))
    return link(terms, [dictionary])


@query("""WITH p AS (SELECT p_partkey % 6 AS k, p_name FROM part), r AS (SELECT CASE k WHEN 0 THEN 'name' WHEN 1 THEN 'rewritten' WHEN 2 THEN 'rewritten' WHEN 3 THEN 'unmatched' WHEN 4 THEN 'no text' ELSE 'alias' END AS name FROM p)
SELECT name, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS share FROM r GROUP BY 1""")
def linking_reasons(read):
    """Q14: why phrases made of parts' names are linked or not; the counts add up to the rows."""
    part = read("part").select("p_partkey", "p_name")
    k = F.col("p_partkey") % 6
    text = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat(F.lit("chronic "), "p_name")).when(k == 2, F.concat(F.lit("zzqx thing and "), "p_name")).when(k == 3, F.concat("p_name", F.lit(" zzqx"))).when(k == 4, F.lit(" ")).otherwise(F.concat(F.lit("so called "), "p_name"))
    own = part.select(fold(F.col("p_name")).alias("probe"), "p_name").groupBy("probe").agg(F.min("p_name").alias("key"))
    alias = own.select(F.concat(F.lit("so called "), "probe").alias("probe"), "key")
    found = coverage.reasons(part.select(F.col("p_partkey").alias("id"), text.alias("conditions")), [own, alias])
    return coverage.shares(found).select("name", "n", "share")


@query()
def chunked_documents(read):
    """Documents cut into chunks by layout, plain ones where neighbouring sentences are far apart."""
    return chunk.chunk(read("documents"), "doc_id", page=None, embed=vectors.hashed)


@query("SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(read):
    """Windows of a day over events; the same function serves a stream."""
    out = events.tumbling(read("events").withColumn("value", F.col("value").cast("decimal(18,2)")))
    return out.select(F.to_date("start").alias("day"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query("SELECT CAST(date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS DATE) AS day, event_type, count(*) AS n FROM events, unnest([0, 1]) AS u(k) GROUP BY 1, 2")
def sliding_windows(read):
    """Windows of two days, each day."""
    return events.sliding(read("events"), "2 days", "1 day").select(F.to_date("start").alias("day"), "event_type", "n")


@query("""SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session""")
def session_windows(read):
    """A user's events without a pause of six hours."""
    return events.sessions(read("events")).select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events GROUP BY ALL")
def events_once(read):
    """Each key once."""
    return events.once(read("events").select("user_id", F.to_date("ts").alias("day"), "event_type"), ["user_id", "day", "event_type"], time="day")


@query("""SELECT user_id, event_type, count(*) AS run, min(event_id) AS first_event FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS island FROM events) GROUP BY user_id, event_type, island HAVING count(*) >= 3""")
def streamed_runs(read):
    """Runs of at least three equal values, from a stream with keyed state."""
    table = read("events")
    spark = table.sparkSession
    # A table may be one file or a folder of them.
    folder, _, name = read.path("events").rpartition("/")
    stream = spark.readStream.schema(table.schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{folder}/{name[:-1]}[{name[-1]}]")
    keyed = stream.select(F.col("user_id").alias("key"), F.col("event_type").alias("kind"), F.col("event_id").cast("bigint").alias("ord"), F.col("ts").cast("timestamp").alias("ts"))
    told = state.drain_to(state.runs(keyed, idle=10**12), shared_dir(spark, "runs-state"), shared_dir(spark, "runs"))
    # A run that was open at the end of a batch is told again when it is longer.
    whole = told.groupBy("key", "kind", "first").agg(F.max("run").alias("run")).filter("run >= 3")
    return whole.select(F.col("key").alias("user_id"), F.col("kind").alias("event_type"), "run", F.col("first").alias("first_event"))


@query("SELECT content, doc_id, n - 1 AS n_copies FROM (SELECT md5(substr(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), 1, 600)) AS content, min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY 1)")
def collapsed_contents(read):
    """One row a content, with the number of the others."""
    from tessera.functions.text import content_key

    return read("documents").groupBy(content_key(F.col("text")).alias("content")).agg(F.min("doc_id").alias("doc_id"), (F.count("*") - 1).alias("n_copies"))


@query("SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) :: BIGINT AS so_far FROM conversations")
def running_lengths(read):
    """Running sums in a group."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return read("conversations").select("conv_id", "turn", F.sum(F.length("text")).over(w).alias("so_far"))
