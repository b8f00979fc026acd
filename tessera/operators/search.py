"""Vector, sparse and full-text search with a relevance gate and collapsing of duplicates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vectors
from tessera.functions.text import content_key, fold
from tessera.scratch import written

#: Bounds of one query's results, and the gate.
CANDIDATES, FINAL, GATHER, GATE, SAME = 250, 15, 60, 0.6, 0.95
#: Products of vectors that a task holds at a time.
PRODUCTS = 4_000_000


def by_cosine(items: DataFrame, query: list[float], k: int = CANDIDATES, vector: str = "embedding", id_col: str = "id") -> DataFrame:
    """The k items nearest to one query: (items, cosine), ties by id."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return items.withColumn("cosine", vectors.cosine(F.col(vector), q)).orderBy(F.desc("cosine"), id_col).limit(k)


def by_cosine_many(items: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", id_col: str = "id", block: int = 10_000) -> DataFrame:
    """(query_id, id, cosine, rank): exact nearest items of many queries (query_id, query).

    Queries are dealt to blocks of about ``block``; one block at a time is held on the driver and
    read by every task, and of several its answers are written before the next one is read. Each task keeps
    k items a query, so k rows a query and task are shuffled.
    """
    blocks = -(-queries.count() // block) or 1
    dealt = queries.withColumn("_block", F.pmod(F.xxhash64(queries.columns[0]), F.lit(blocks)))
    kept = (lambda rows: rows) if blocks == 1 else (lambda rows: written(rows, "nearest"))
    found = [kept(_nearest(items, dealt.filter(F.col("_block") == i).drop("_block"), k, vector, id_col)) for i in range(blocks)]
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id")))
    return ranked.filter(F.col("rank") <= k)


def _nearest(items: DataFrame, queries: DataFrame, k: int, vector: str, id_col: str) -> DataFrame:
    """(query_id, id, cosine): for each task and query of one block, its k nearest items and ties of the last."""
    asked = queries.collect()
    ids, q = [r[0] for r in asked], np.array([r[1] for r in asked], np.float64).reshape(len(asked), -1)
    q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
    kind = items.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A few million products at a time.
        step = max(k + 1, PRODUCTS // max(1, len(ids)))
        for whole in frames:
            for lo in range(0, len(whole) if ids else 0, step):
                f = whole.iloc[lo : lo + step]
                x = np.array(f[vector].tolist(), np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                score = x @ q.T
                # Whole ties are kept: all that score no less than the k-th.
                edge = np.partition(score, -k, axis=0)[-k] if len(x) > k else np.full(len(ids), -np.inf)
                row, col = np.nonzero(score >= edge)
                yield pd.DataFrame({"query_id": [ids[c] for c in col], "id": f[id_col].to_numpy()[row], "cosine": score[row, col]})

    query_kind = queries.schema[0].dataType.simpleString()
    return items.select(id_col, vector).mapInPandas(run, f"query_id {query_kind}, id {kind}, cosine double")


def by_sparse(items: DataFrame, query: dict[str, float], k: int = CANDIDATES, weights: str = "sparse", id_col: str = "id") -> DataFrame:
    """The k items with the largest sum of weight products."""
    terms = sum((F.coalesce(F.element_at(F.col(weights), F.lit(t)), F.lit(0.0)) * F.lit(float(w)) for t, w in query.items()), F.lit(0.0))
    return items.withColumn("sparse_score", terms).filter("sparse_score > 0").orderBy(F.desc("sparse_score"), id_col).limit(k)


def hybrid(items: DataFrame, query: list[float], sparse: dict[str, float], where: Column | None = None, k: int = CANDIDATES, vector: str = "embedding", id_col: str = "id") -> DataFrame:
    """Dense and sparse candidates under one filter, all scored by cosine."""
    pool = items.filter(where) if where is not None else items
    both = by_cosine(pool, query, k, vector, id_col).select(id_col).union(by_sparse(pool, sparse, k, id_col=id_col).select(id_col)).distinct()
    return by_cosine(pool.join(F.broadcast(both), id_col), query, k, vector, id_col)


def gate(hits: DataFrame, least: float = GATE, group: str | None = None) -> DataFrame:
    """All hits if the best reaches the gate; else none. With a group, of each query's hits for themselves."""
    if group:
        return hits.withColumn("_best", F.max("cosine").over(Window.partitionBy(group))).filter(F.col("_best") >= least).drop("_best")
    best = hits.agg(F.max("cosine").alias("_best"))
    return hits.join(F.broadcast(best)).filter(F.col("_best") >= least).drop("_best")


def collapse(hits: DataFrame, text: str = "text", source: str = "source", id_col: str = "id", gather: int = GATHER) -> DataFrame:
    """The best hit of each content, with the sources of all others, in order; the first ``gather`` contents."""
    place = F.struct((-F.col("cosine")).alias("c"), F.col(id_col).alias("i"))
    best = hits.withColumn("_at", place).groupBy(content_key(F.col(text)).alias("_key")).agg(F.min_by(F.struct(*hits.columns), "_at").alias("w"), F.min("_at").alias("_at"), F.array_sort(F.collect_list(F.struct("_at", source))).alias("_all"))
    return best.orderBy("_at").limit(gather).select("w.*", F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda x: x[source]).alias("duplicates"))


def greedy_distinct(hits: DataFrame, final: int | None = FINAL, same: float = SAME, vector: str = "embedding", id_col: str = "id", group: str | None = None, most: int = 200_000) -> DataFrame:
    """(group, id, rank, merged): in order, a hit stays unless it is like one that stays already.

    Order decides, so a group's hits meet in one task: at most ``most`` of them, beyond
    which it raises. A group is what was gathered for one search, or a narrow block.
    final: the first so many of those that stay, or all (None).
    """
    grouped = hits.withColumn("_g", F.col(group) if group else F.lit(0)).select("_g", F.col(id_col).alias("id"), "cosine", F.col(vector).alias("v"))

    def walk(f: pd.DataFrame) -> pd.DataFrame:
        if len(f) > most:
            raise ValueError("too many hits in one group for a walk in order")
        f = f.sort_values(["cosine", "id"], ascending=[False, True])
        x = np.array(f["v"].tolist(), np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        kept, merged = [], {}
        for lo in range(0, len(x), 512):
            # One product against all that stayed before the block, then a row each inside it.
            block = x[lo : lo + 512]
            before = block @ x[kept].T >= same if kept else np.zeros((len(block), 0), bool)
            inside = block @ block.T >= same
            old, fresh = list(kept), []
            for i in range(len(block)):
                near = old[int(np.argmax(before[i]))] if before[i].any() else next((lo + j for j in fresh if inside[i, j]), None)
                if near is None:
                    fresh.append(i)
                    kept.append(lo + i)
                    merged[lo + i] = []
                else:
                    merged[near].append(str(f["id"].iloc[lo + i]))
        kept = kept[:final]
        return pd.DataFrame({"grp": [f["_g"].iloc[0]] * len(kept), "id": [f["id"].iloc[i] for i in kept], "rank": range(1, len(kept) + 1), "merged": [merged[i] for i in kept]})

    kinds = grouped.schema
    return grouped.groupBy("_g").applyInPandas(walk, f"grp {kinds['_g'].dataType.simpleString()}, id {kinds['id'].dataType.simpleString()}, rank int, merged array<string>")


def retrieve(items: DataFrame, query: list[float], sparse: dict[str, float], where: Column | None = None, final: int = FINAL) -> DataFrame:
    """Search as the API does it: hybrid, gate, collapse, greedy distinct. Items: id, text, source, embedding, sparse."""
    hits = collapse(gate(hybrid(items, query, sparse, where)), gather=max(3 * final, GATHER))
    stay = greedy_distinct(hits, final)
    return hits.join(F.broadcast(stay), "id").select("id", "rank", "cosine", "text", "source", F.concat("duplicates", "merged").alias("duplicates")).orderBy("rank")


def words_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, w): the folded words of each text, in order."""
    return docs.select(F.col(id_col).alias("id"), F.filter(F.split(fold(F.col(text)), " "), lambda w: w != "").alias("w"))


def postings(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, token, pos, n_tokens): an inverted index with positions."""
    return words_of(docs, id_col, text).select("id", F.size("w").alias("n_tokens"), F.posexplode("w").alias("pos", "token"))


def bm25(words: DataFrame, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) of documents (``words_of``) with any of the tokens; a document sends one row a token that it has."""
    query = list(dict.fromkeys(query))

    def times(token: str) -> Column:
        return F.struct(F.lit(token).alias("token"), F.size(F.filter("w", lambda x: x == token)).alias("tf"))

    counted = words.select("id", F.size("w").alias("n_tokens"), F.array(*map(times, query)).alias("t"))
    corpus = counted.filter("n_tokens > 0").agg(F.count("*").alias("n_docs"), F.avg("n_tokens").alias("mean"))
    tf = counted.select("id", "n_tokens", F.explode("t").alias("t")).select("id", "n_tokens", "t.*").filter("tf > 0")
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    gain = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n_tokens") / F.col("mean")))
    # One row a token of the query, and one row.
    return tf.join(F.broadcast(df), "token").join(F.broadcast(corpus)).groupBy("id").agg(F.sum(gain).alias("score"))


def phrase_count(words: list[str]) -> Column:
    """Places of ``w`` where the words follow each other."""
    at = F.sequence(F.lit(0), F.size("w") - len(words))
    here = lambda i: F.reduce(F.array(*[F.get("w", i + k) == F.lit(x) for k, x in enumerate(words)]), F.lit(True), lambda a, x: a & x)
    return F.when(F.size("w") >= len(words), F.size(F.filter(at, here))).otherwise(0).cast("long")


def phrase(words: DataFrame, query: list[str]) -> DataFrame:
    """(id, n): documents (``words_of``) and their places where the words follow each other."""
    first = words.filter(F.arrays_overlap("w", F.array(F.lit(query[0]))))
    return first.select("id", phrase_count(query).alias("n")).filter("n > 0")


def fuzzy_tokens(words: DataFrame, word: str, most: int = 2) -> DataFrame:
    """(token, distance): tokens of the documents within an edit distance; each token is compared once."""
    return words.select(F.explode(F.array_distinct("w")).alias("token")).distinct().withColumn("distance", F.levenshtein("token", F.lit(word))).filter(F.col("distance") <= most)


def phrase_check(words: DataFrame, query: list[str]) -> DataFrame:
    """(n_phrase, n_any): documents with the phrase, and with any of its words."""
    any_ = F.arrays_overlap("w", F.array(*map(F.lit, query)))
    return words.agg(F.count_if(phrase_count(query) > 0).alias("n_phrase"), F.count_if(any_).alias("n_any"))
