"""The operators as registered queries, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    ann,
    divergence,
    graph_dedup,
    hard_negatives,
    langid,
    line_dedup,
    lm_scoring,
    minhash,
    mixing,
    packing,
    substrings,
    toxicity,
    url_rules,
)
from landfall.llm.common import Work, fold, table
from landfall.llm.vectors import usable

#: The curated rules as (verdict, host, path).
HOST_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def lm_scoring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    return lm_scoring.score(Work(spark, "op1"), docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """Learned from labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 4) != 2)
    return toxicity.fit(docs.filter(fold(F.col("doc_id"), 4) != 2), labels)


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    return toxicity.score(docs, toxicity_model(spark, sf_dir, docs), keep=["doc_id", "held_out"])


def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = Work(spark, "op3").keep(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return ann.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad when its label (by id) says low quality or toxic."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad)
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), labels, HOST_RULES, work=Work(spark, "op5"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def graph_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors without a usable value link with nothing; they are returned as their own components. Their ``recall`` is null."""
    work, rows = Work(spark, "op6"), table(spark, sf_dir, "embeddings")
    found = graph_dedup.near_duplicates(work, work.keep(usable(rows), "vectors"), least=0.9)
    found = found.withColumnRenamed("vec_id", "_id")
    joined = rows.select(F.col("vec_id").cast("long").alias("vec_id")).join(found, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"), "recall",
    )


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        Work(spark, "op7"), table(spark, sf_dir, "documents"), tokenizer(), window=1024, end_id=0, carry={"ids_crc32": F.crc32("ids")}
    )
    return pieces.select("doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


def line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(Work(spark, "op8"), docs, min_chars=40, min_docs=5)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(Work(spark, "op9"), table(spark, sf_dir, "documents"), percent=85)


def langid_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    return langid.predict(docs, langid.fit(docs.filter(~F.col("held_out"))), keep=["doc_id", "held_out"])


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substrings.dedup_substrings(Work(spark, "op11"), docs, width=50)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(Work(spark, "op12"), table(spark, sf_dir, "documents").select("lang", "source", "text"))


def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector counts under the next label, of ten."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.mine(Work(spark, "op13"), rows, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_lm_scoring": lm_scoring_query,
    "op2_toxicity": toxicity_query,
    "op3_nearest_neighbours": ann_query,
    "op4_mixing": mixing_query,
    "op5_url_filter": url_query,
    "op6_embedding_dedup": graph_query,
    "op7_packing": packing_query,
    "op8_line_dedup": line_query,
    "op9_minhash_dedup": minhash_query,
    "op10_language_id": langid_query,
    "op11_substring_dedup": substring_query,
    "op12_source_divergence": divergence_query,
    "op13_hard_negatives": hard_negatives_query,
}

UPPER, LOWER = url_rules.UPPER, url_rules.LOWER
BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op4_mixing": r"""
        with d as (
            select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
        ), s as (
            select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) as nth from d group by source
        ), w as (
            select *, (case (nth - 1) % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end)::double as weight,
                   source_size * 2.0::double as cap, (sum(source_size) over ())::double * 1.5::double as budget from s
        ), l as (
            select *, (budget - coalesce(sum(cap) over (order by cap / weight, nth rows between unbounded preceding and 1 preceding), 0))
                      / sum(weight) over (order by cap / weight, nth rows between current row and unbounded following) as level from w
        ), f as (
            select *, row_number() over (order by cap / weight, nth) as place from l
        ), t as (
            select source, source_size,
                   case when place < coalesce((select min(place) from f where cap / weight >= level), 2147483648) then cap
                        else least(cap, (select level from f where cap / weight >= level order by place limit 1) * weight) end as target
            from f
        ), r as (
            select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
                   row_number() over (partition by d.source order by size, ((doc_id % 1024) + 1024) % 1024, doc_id) - 1 as place,
                   ('0x' || substr(md5(coalesce(d.source, '') || '/7'), 1, 8))::bigint / 4294967296.0::double as shift
            from d join t on d.source is not distinct from t.source
        )
        select doc_id, size, source_size, target,
               (least(2, floor((place + 1) * rate + shift) - floor(place * rate + shift)) * size)::bigint as taken
        from r
    """,
    "op8_line_dedup": f"""
        with d as (
            select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), l as (
            select doc_id, i, lines[i] as line, translate(trim(lines[i], {BLANK}), '{UPPER}', '{LOWER}') as key
            from d, unnest(range(1, len(lines) + 1)) as u(i)
        ), k as (
            select key, max(doc_id) as top from l where length(key) >= 40 group by key having count(distinct doc_id) >= 5
        ), m as (
            select l.*, k.key is not null and l.doc_id <> k.top as lost from l left join k on l.key = k.key
        )
        select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (not lost), '')) as kept_sha256
        from m group by doc_id
    """,
    "op9_minhash_dedup": rf"""
        with recursive d as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'),
                                       lambda x: x <> '') as w
            from documents
        ), s as (
            select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as shingle
            from d
        ), n as (
            select doc_id, count(*) as n from s group by doc_id
        ), p as (
            select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            group by 1, 2
        ), links as (
            select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)
        ), reach(id, other) as (
            select doc_id, doc_id from documents union select reach.id, links.b from reach join links on links.a = reach.other
        ), c as (
            select id, min(other) as component_id from reach group by id
        )
        select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
        from documents d left join n using (doc_id) join c on c.id = d.doc_id
    """,
    "op11_substring_dedup": r"""
        with d as (
            select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
        ), n as (
            select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from d, unnest(range(1, len(w) - 48)) as u(i)
        ), f as (
            select h, min(doc_id) as first from n group by h having min(doc_id) < max(doc_id)
        ), g as (
            select distinct doc_id, i + k as j from n join f using (h), range(50) as r(k) where doc_id > first
        ), l as (
            select d.doc_id, i as j, w[i] as word from d, unnest(range(1, len(w) + 1)) as u(i)
        ), k as (
            select l.doc_id, count(*) as n_words, count(g.j) as n_removed,
                   string_agg(word, ' ' order by l.j) filter (g.j is null) as kept
            from l left join g on g.doc_id = l.doc_id and g.j = l.j group by l.doc_id
        )
        select doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from d left join k using (doc_id)
    """,
    "op12_source_divergence": rf"""
        with d as (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as text
            from documents
        ), o as (
            select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
        ), kept as (
            select lang, term, count(*) as n from o group by 1, 2 having count(distinct row) >= 10
        ), langs as (
            select d.lang, count(k.term) as v, coalesce(sum(k.n), 0) as total
            from (select distinct lang from d) as d left join kept as k using (lang) group by 1
        ), groups as (
            select distinct lang, source from d
        ), c as (
            select g.lang, g.source, k.term, count(o.term) as n, any_value(k.n) as lang_n
            from groups as g join kept as k using (lang)
                left join o on o.lang = g.lang and o.source = g.source and o.term = k.term
            group by 1, 2, 3
        ), t as (
            select lang, source, sum(n) as total from c group by 1, 2
        ), p as (
            select lang, source, term, n, 1 + (1000000000::hugeint * (n + 2)) // (t.total + 2 * v) as p,
                   1 + (1000000000::hugeint * (lang_n + 2)) // (langs.total + 2 * v) as q
            from c join t using (lang, source) join langs using (lang)
        ), sums as (
            select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
            from p as a join p as b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3
        ), all_parts as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sums.value, 0)::bigint as value
            from groups as a join groups as b on a.lang = b.lang and a.source <> b.source
                left join sums on sums.lang = a.lang and sums.source = a.source and sums.item = b.source
            union all
            select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q
        ), ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from all_parts
        )
        select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
    """,
    "op13_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding::double[], lambda x: floor(256 * x)) as q
            from embeddings
            where label is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), s as (
            select a.vec_id as anchor_id, b.vec_id, b.label = a.label as same, list_dot_product(a.q, b.q)::bigint as score
            from v as a join v as b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
        ), p as (
            select anchor_id, vec_id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ), n as (
            select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                   row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
            from p join s using (anchor_id)
            where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
    """,
}
