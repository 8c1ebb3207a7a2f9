"""Text and retrieval: chunks, BM25, vector and hybrid search, context packing, pattern scans, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import table

#: BM25 parameters, chunk size and overlap.
K1, B = 1.5, 0.75
CHUNK, OVERLAP = 500, 50


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\t\n\r\f\x0B]+"), lambda w: w != "")


def chunk_words(df: DataFrame, key: str, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, chunk_index, chunk, n_words: windows of `size` words, each `overlap` over the last; the last one ends with the text."""
    stride = size - overlap
    w = df.select(key, words(F.col("text")).alias("w")).where(F.size("w") > 0)
    n = F.when(F.size("w") <= size, 1).otherwise(F.ceil((F.size("w") - size) / stride) + 1)
    at = w.select(key, "w", F.explode(F.sequence(F.lit(0), n.cast("int") - 1)).alias("chunk_index"))
    part = F.slice("w", F.col("chunk_index") * stride + 1, F.lit(size))
    return at.select(key, "chunk_index", F.array_join(part, " ").alias("chunk"), F.size(part).alias("n_words"))


def postings(df: DataFrame, key: str) -> DataFrame:
    """term, key, tf; counts are combined before the shuffle."""
    return df.select(key, F.explode(words(F.lower("text"))).alias("term")).groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"))


def bm25(df: DataFrame, key: str, query: str) -> DataFrame:
    """key, score > 0. Only the query's terms leave the scan; a term that the query repeats counts twice."""
    terms = query.lower().split()
    q = df.sparkSession.createDataFrame([(t, terms.count(t)) for t in sorted(set(terms))], "term string, times long")
    lengths = df.select(key, words(F.lower("text")).alias("w")).select(key, "w", F.size("w").alias("len"))
    stats = lengths.agg(F.count(F.lit(1)).alias("N"), F.avg("len").alias("avgdl"))
    hits = lengths.select(key, "len", F.explode(F.filter("w", lambda t: t.isin(terms))).alias("term")).groupBy(key, "len", "term").agg(F.count(F.lit(1)).alias("tf"))
    df_ = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # the query's terms and the corpus totals are a handful of rows
    weighted = hits.join(F.broadcast(df_.join(q, "term")), "term").crossJoin(F.broadcast(stats))
    idf = F.log((F.col("N") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avgdl")))
    return weighted.groupBy(key).agg(F.sum(F.col("times") * idf * tf).alias("score")).where("score > 0")


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda acc, v: acc + v)


def nearest(vectors: DataFrame, query: list[float], k: int) -> DataFrame:
    q = F.array(*[F.lit(float(x)) for x in query])
    return vectors.select("vec_id", F.sqrt(squared_distance(F.col("embedding"), q)).alias("distance")).orderBy("distance", "vec_id").limit(k)


QUERY = "the of and thing the"


def word_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chunk_words(table(spark, sf_dir, "documents"), "doc_id")
    return c.select("doc_id", "chunk_index", "n_words", F.md5("chunk").alias("chunk_md5"))


def term_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = postings(table(spark, sf_dir, "documents"), "doc_id")
    return p.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = bm25(table(spark, sf_dir, "documents"), "doc_id", QUERY).withColumn("score", F.round("score", 6))
    return s.orderBy(F.desc("score"), "doc_id").limit(20)


def _query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    return list(table(spark, sf_dir, "embeddings").where("vec_id = 0").head()["embedding"])


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), 20).select("vec_id", F.round("distance", 6).alias("distance"))


def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0.6 of the nearness (one minus distance over the largest) and 0.4 of the score over the largest; both lists are top-k."""
    v = nearest(table(spark, sf_dir, "embeddings"), _query_vector(spark, sf_dir), 60)
    b = bm25(table(spark, sf_dir, "documents"), "doc_id", QUERY).withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), "doc_id").limit(60)
    j = v.join(b.withColumnRenamed("doc_id", "vec_id"), "vec_id", "full")
    top = j.agg(F.max("distance").alias("d"), F.max("score").alias("s"))
    near = F.when(F.col("distance").isNotNull(), 1 - F.coalesce(F.try_divide("distance", "d"), F.lit(0.0))).otherwise(0.0)
    both = 0.6 * near + 0.4 * F.coalesce(F.try_divide("score", "s"), F.lit(0.0))
    return j.crossJoin(F.broadcast(top)).select("vec_id", F.round(both, 6).alias("hybrid")).orderBy(F.desc("hybrid"), "vec_id").limit(20)


def context_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation the turns from the first on, until the next would exceed 600 characters; one at least."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").alias("n"))
    w = W.partitionBy("conv_id").orderBy("turn")
    run = c.withColumn("total", F.sum("n").over(w)).withColumn("k", F.row_number().over(w))
    over = F.when((F.col("total") > 600) & (F.col("k") > 1), F.col("k"))
    cut = run.withColumn("stop", F.min(over).over(W.partitionBy("conv_id")))
    return cut.where("stop is null or k < stop").select("conv_id", "turn", "n", "total")


#: Fixed order: the first method that fits is the document's.
METHODS = (("licensed", "licen[sc]ed?"), ("token", "token"), ("mail", "@"), ("table", r"\|"), ("numbers", "[0-9]{4}"))


def method_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rank = F.lit(None).cast("string")
    for name, p in reversed(METHODS):
        rank = F.when(F.lower("text").rlike(p), name).otherwise(rank)
    n = sum(F.lower("text").rlike(p).cast("int") for _, p in METHODS)
    return d.select("doc_id", rank.alias("method"), n.alias("matches")).where("method is not null")


def condition_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    year, version = F.regexp_extract("text", r"\b((?:19|20)[0-9]{2})\b", 1), F.regexp_extract("text", r"Version ([0-9]+\.[0-9]+)", 1)
    return d.select("doc_id", F.nullif(year, F.lit("")).alias("year"), F.nullif(version, F.lit("")).alias("version")).where("year is not null or version is not null")


def relevance_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of keywords that a text contains; kept from 0.4 on."""
    keys = ("the", "que", "und", "licensed", "token")
    hit = sum(F.lower("text").contains(k).cast("int") for k in keys)
    return table(spark, sf_dir, "documents").select("doc_id", F.round(hit / len(keys), 6).alias("relevance")).where("relevance >= 0.4")


def paper_rubric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points for what a page shows; the best two hundred, a report."""
    h = F.col("html")
    points = 4 * h.contains("<article").cast("int") + 3 * h.contains("<table").cast("int") + 2 * h.contains("<h1").cast("int") + 2 * (F.length("url") < 40).cast("int") + h.rlike("lang=\"en\"").cast("int") + h.contains("<nav").cast("int")
    return table(spark, sf_dir, "pages").select("page_id", points.alias("points")).orderBy(F.desc("points"), "page_id").limit(200)


def section_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines numbered from 1; a line of one word ending in a stop is a header, lines belong to the last header seen."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    header = F.when(F.col("line").rlike(r"^\S+\.$"), F.col("line"))
    w = W.partitionBy("doc_id").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    s = d.withColumn("section", F.last(header, ignorenulls=True).over(w))
    return s.groupBy("doc_id", F.coalesce("section", F.lit("")).alias("section")).agg(F.min(F.col("k") + 1).alias("first_line"), F.count(F.lit(1)).alias("lines"))


def rerank(results: DataFrame, order: list[Column], k: int, score: Column | None = None) -> DataFrame:
    """The k best of a short list of results (top-k, so one task holds it) by a model's score, else by their order, from 1 down by hundredths."""
    ranked = results.withColumn("_rank", F.row_number().over(W.orderBy(*order)) - 1)
    scored = ranked.withColumn("rerank", score if score is not None else 1.0 - 0.01 * F.col("_rank"))
    return scored.orderBy(F.desc("rerank"), "_rank").limit(k).drop("_rank")


def reranked_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rerank(bm25_topk(spark, sf_dir), [F.desc("score"), F.col("doc_id")], 10).select("doc_id", F.round("rerank", 6).alias("rerank"))


def nearest_place(text: Column, value: Column, mention: Column) -> Column:
    """Where (from 1) the value stands nearest to the first mention, the earlier of equals; its first place without a mention; null if it stands nowhere."""
    at, n = F.instr(text, mention), F.char_length(value)
    left, right = F.substring(text, F.lit(1), at - 1), F.substring(text, at, F.char_length(text))
    back = F.instr(F.reverse(left), F.reverse(value))
    before = F.when(back > 0, F.char_length(left) - back - n + 2)
    after = F.when(F.instr(right, value) > 0, at + F.instr(right, value) - 1)
    near = F.when(F.coalesce(at - before <= after - at, before.isNotNull()), before).otherwise(after)
    return F.when((value != "") & F.contains(text, value), F.when(at > 0, F.coalesce(near, F.nullif(F.instr(text, value), F.lit(0)))).otherwise(F.nullif(F.instr(text, value), F.lit(0))))


def evidence_window(text: Column, value: Column, mention: Column, width: int = 200) -> Column:
    """struct(start, window): the place nearest to the mention, `width` characters before it and up to the first sentence end among those after it."""
    start, n = nearest_place(text, value, mention), F.char_length(value)
    lead = F.greatest(start - width, F.lit(1))
    tail = F.substring(text, start + n, F.lit(width))
    ended = F.when(F.contains(tail, F.lit(". ")), F.concat(F.substring_index(tail, ". ", 1), F.lit("."))).otherwise(tail)
    return F.when(start.isNotNull(), F.struct(start.alias("start"), F.concat(F.substring(text, lead, start - lead), value, ended).alias("window")))


def evidence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's third word, nearest to its twelfth."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    word = lambda k: F.coalesce(F.get(F.split("text", " "), F.lit(k)), F.lit(""))
    own = d.select("doc_id", "text", word(2).alias("value"), word(11).alias("mention"))
    w = own.select("doc_id", evidence_window(F.col("text"), F.col("value"), F.when(F.col("mention") != "", F.col("mention")).otherwise("\u0000")).alias("w"))
    return w.where("w is not null").select("doc_id", "w.start", F.sha2("w.window", 256).alias("sha256"))


QUERIES = {f.__name__: f for f in (reranked_topk, evidence_windows, word_chunks, term_statistics, bm25_topk, vector_topk, hybrid_topk, context_pack, method_scan, condition_regex, relevance_triage, paper_rubric, section_parser)}

_SP = "[\\x20\\t\\n\\r\\f\\x0B]+"
_W = f"list_filter(regexp_split_to_array({{t}}, '{_SP}'), lambda w: w <> '')"
_BM = f"""d as (select doc_id, {_W.format(t='lower(text)')} w from documents), s as (select count(*) N, avg(len(w)) a from d), q as (select * from (values ('the', 2), ('of', 1), ('and', 1), ('thing', 1)) q(term, times)), h as (select doc_id, len(w) l, t.term, count(*) tf from (select doc_id, w, unnest(w) term from d) t where term in (select term from q) group by 1, 2, 3),
f as (select term, count(*) df from h group by 1), b as (select doc_id, round(sum(times * ln((N - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * l / a))), 6) score from h join f using (term) join q using (term) cross join s group by 1)"""
_V = "v as (select e.vec_id, sqrt(list_sum(list_transform(list_zip(e.embedding, q.embedding), lambda z: pow(z[1]::double - z[2]::double, 2)))) distance from embeddings e, (select embedding from embeddings where vec_id = 0) q)"
SQL = {
    "word_chunks": f"with w as (select doc_id, {_W.format(t='text')} w from documents), c as (select doc_id, w, unnest(range(0, case when len(w) <= 500 then 1 else ceil((len(w) - 500) / 450)::bigint + 1 end)) i from w where len(w) > 0) select doc_id, i::int chunk_index, len(w[i * 450 + 1 : i * 450 + 500])::int n_words, md5(array_to_string(w[i * 450 + 1 : i * 450 + 500], ' ')) chunk_md5 from c",
    "term_statistics": f"select term, count(*) df, cast(sum(tf) as bigint) tf from (select doc_id, term, count(*) tf from (select doc_id, unnest({_W.format(t='lower(text)')}) term from documents) group by 1, 2) group by 1",
    "bm25_topk": f"with {_BM} select doc_id, score from b where score > 0 order by score desc, doc_id limit 20",
    "reranked_topk": f"with {_BM}, t as (select doc_id, score from b where score > 0 order by score desc, doc_id limit 10) select doc_id, round(1 - 0.01 * (row_number() over (order by score desc, doc_id) - 1), 6)::double as rerank from t",
    "evidence_windows": """
    with o as (select doc_id, text, coalesce(string_split(text, ' ')[3], '') as v, coalesce(string_split(text, ' ')[12], '') as m from documents where text is not null),
    p as (select *, case when m = '' then 0 else strpos(text, m) end as p, length(v) as n from o where v <> ''),
    s as (select *, strpos(reverse(substr(text, 1, p - 1)), reverse(v)) as back, strpos(substr(text, p), v) as fore from p),
    b as (select *, case when p > 0 and back > 0 then p - 1 - back - n + 2 end as before, case when p > 0 and fore > 0 then p + fore - 1 end as after from s),
    c as (select *, coalesce(case when p - before <= after - p or after is null then before else after end, strpos(text, v)) as start from b),
    w as (select *, greatest(start - 200, 1) as lead, substr(text, start + n, 200) as tail from c)
    select doc_id, start::int as start, sha256(substr(text, lead, start - lead) || v || case when contains(tail, '. ') then split_part(tail, '. ', 1) || '.' else tail end) as sha256 from w""",
    "vector_topk": f"with {_V} select vec_id, round(distance, 6) distance from v order by v.distance, vec_id limit 20",
    "hybrid_topk": f"with {_BM}, {_V}, x as (select vec_id, distance from v order by distance, vec_id limit 60), y as (select doc_id vec_id, score from b order by score desc, doc_id limit 60), j as (select * from x full join y using (vec_id)), hy as (select vec_id, round(0.6 * case when distance is null then 0 else 1 - coalesce(distance / nullif((select max(distance) from j), 0), 0) end + 0.4 * coalesce(score / (select max(score) from j), 0), 6) hybrid from j) select * from hy order by hybrid desc, vec_id limit 20",
    "context_pack": "with r as (select conv_id, turn, length(text) n, sum(length(text)) over (partition by conv_id order by turn) total, row_number() over (partition by conv_id order by turn) k from conversations), s as (select *, min(case when total > 600 and k > 1 then k end) over (partition by conv_id) stop from r) select conv_id, turn, n::int n, total::bigint total from s where stop is null or k < stop",
    "method_scan": "select * from (select doc_id, case " + " ".join(f"when regexp_matches(lower(text), '{p}') then '{n}'" for n, p in METHODS) + " end as method, " + " + ".join(f"regexp_matches(lower(text), '{p}')::int" for _, p in METHODS) + " matches from documents) where method is not null",
    "condition_regex": "select * from (select doc_id, nullif(regexp_extract(text, '\\b((?:19|20)[0-9]{2})\\b', 1), '') as year, nullif(regexp_extract(text, 'Version ([0-9]+\\.[0-9]+)', 1), '') as version from documents) where year is not null or version is not null",
    "relevance_triage": "select * from (select doc_id, round((contains(lower(text), 'the')::int + contains(lower(text), 'que')::int + contains(lower(text), 'und')::int + contains(lower(text), 'licensed')::int + contains(lower(text), 'token')::int) / 5, 6) relevance from documents) where relevance >= 0.4",
    "paper_rubric": "select page_id, 4 * contains(html, '<article')::int + 3 * contains(html, '<table')::int + 2 * contains(html, '<h1')::int + 2 * (length(url) < 40)::int + contains(html, 'lang=\"en\"')::int + contains(html, '<nav')::int points from pages order by points desc, page_id limit 200",
    "section_parser": "with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) k from documents), s as (select *, last_value(case when regexp_matches(line, '^\\S+\\.$') then line end ignore nulls) over (partition by doc_id order by k rows unbounded preceding) section from l) select doc_id, coalesce(section, '') section, min(k)::int first_line, count(*) lines from s group by 1, 2",
}
