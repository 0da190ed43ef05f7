"""One query per operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    centroid_clustering,
    conversation_repair,
    embedding_dedup,
    exact_dedup,
    line_dedup,
    minhash_dedup,
    packing,
    piece_codec,
    quality,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from eventmart.llm.common import UPPER, stored, table, text_or_empty
from eventmart.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


OP1_SQL = f"""
with d as (
  select doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') as norm from documents
)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from d window same as (partition by norm)
"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, quality.teaching_labels(table(spark, sf_dir, "labels")))
    scored = docs.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        quality.scorer(model)(text_or_empty()).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "tier", "step_group",
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text", text_or_empty())
    decoded = piece_codec.round_trip(docs)
    return decoded.select(
        "doc_id", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "same_text"
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path, with_ids=False).drop("ids")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


LANGUAGES = ("en", "de", "fr", "es")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has one toxicity label; the chain goes from toxic text in each
    language to toxic text in any. A quarter of the labels is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    toxic = F.col("toxic") == 1
    categories = {f"toxic_{c}": toxic & (F.coalesce("lang", F.lit("")) == c) for c in LANGUAGES} | {"toxic": toxic}
    chain = toxicity.train(docs, quality.teaching_labels(labels), categories)
    scored = docs.select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), toxicity.scorer(chain)(text_or_empty()).alias("p")
    )
    return scored.select(
        "doc_id",
        "held_out",
        *[F.col("p")[i].alias(f"{c}_score") for i, c in enumerate(categories)],
        (F.col("p")[len(categories) - 1] >= toxicity.FLAGGED).alias("flagged"),
    )


URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of the pages on hosts with a label ``spam-...``."""
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    listed = pages.where(host.rlike(r"(^|\.)spam-")).select(url_filter.canonical(host, path).alias("url"))
    return url_filter.filter_urls(pages, URL_RULES, listed).drop("possible")


OP8_SQL = f"""
with parts as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{UPPER.lower()}') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), ruled as (
  select *, regexp_replace(host, '^(www|m)\\.', '')
            || regexp_replace(regexp_replace(path, '/+\\z', ''), '\\.html\\z', '') as canonical,
         case when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
              when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
              when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
              when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from parts
), listed as (select distinct canonical from ruled where regexp_matches(host, '(^|\\.)spam-'))
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
            when canonical in (select canonical from listed) then 'block' else 'allow' end as verdict
from ruled
"""


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.minhash_classes(table(spark, sf_dir, "documents"), percent=85, shingle=3)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "repeats.n_cut", "repeats.n_passages", "repeats.kept_spans", "text")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed",
        F.size("repeats.spans").cast("long").alias("n_spans"), "repeats.kept_sha256",
    )


OP11_SQL = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), parts as (
  -- texts in stretches first: a cut from a long text costs its whole length
  select doc_id, c, substring(h, 2 * c + 1, 2098) as h, least(1000, n - 49 - c) as windows
  from (select doc_id, h, n, unnest(range(0, greatest(n - 49, 0), 1000)) as c from d)
), w as (
  select doc_id, c + s as s, substring(h, 2 * s + 1, 100) as string
  from (select doc_id, h, c, unnest(range(windows)) as s from parts)
), firsts as (
  select string, min(doc_id) as first_id from w group by string
), starts as (
  select doc_id, s from w join firsts using (string) where first_id < doc_id
), marked as (
  select doc_id, s, s > lag(s) over (partition by doc_id order by s) + 50 as new from starts
), spans as (
  select doc_id, min(s) as begins, max(s) + 50 as ends
  from (select doc_id, s, sum(coalesce(new, true)::int) over (partition by doc_id order by s) as run from marked)
  group by doc_id, run
), between as (
  select d.doc_id, coalesce(lag(ends) over (partition by d.doc_id order by begins), 0) as a, begins as b from d join spans using (doc_id)
  union all
  select d.doc_id, coalesce(max(ends), 0), any_value(n) from d left join spans using (doc_id) group by d.doc_id
), kept as (
  select doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' order by a) as k
  from between join d using (doc_id) group by doc_id
), cut as (
  select doc_id, sum(ends - begins)::bigint as n_removed, count(*) as n_spans from spans group by doc_id
)
select d.doc_id, n::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(k)) as kept_sha256
from d join kept using (doc_id) left join cut using (doc_id)
"""


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    near, centroids = centroid_clustering.cluster_vectors(vectors)
    held = stored(near.select("vec_id", "cluster", "distance"), "clusters")
    sums = held.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # one row per centroid
    inertia = {r.cluster: r.s for r in sums}
    each = [inertia.get(c) for c in range(len(centroids))]
    return held.select(
        "vec_id", "cluster", "distance",
        centroid_clustering.by_cluster(each, "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        centroid_clustering.by_cluster(centroid_clustering.centroid_digests(centroids), "string").alias("centroid_sha256"),
    )


def _op12_sql(k: int = 16, components: int = 64, scale: int = 64, rounds: int = 3, seed: int = 1) -> str:
    """Centroids and assignments, one pair of steps per round."""
    steps = [
        f"""v as materialized (
  select row_number() over () as row_id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as z
  from embeddings
  where len(embedding) = {components}
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || coalesce(vec_id::varchar, '')), z) - 1 as cluster, z as c
  from v order by cluster limit {k}
)"""
    ]
    squares = "list_sum(list_transform(list_zip(z, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} as materialized (
  select row_id, vec_id, z, near.cluster as cluster, near.distance as distance from (
    select row_id, any_value(vec_id) as vec_id, any_value(z) as z,
           min({{'distance': {squares}, 'cluster': cluster}}) as near
    from v, c{r} group by row_id)
)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} as materialized (
  select c{r}.cluster, coalesce(m.c, c{r}.c) as c from c{r} left join (
    select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as c from (
      select cluster, i, sum(z[i]) as s, count(*) as n from (select cluster, z, unnest(range(1, {components + 1})) as i from a{r}) group by cluster, i)
    group by cluster) m using (cluster)
)"""
            )
    return f"""with {", ".join(steps)}
select vec_id, cluster::int as cluster, distance, sum(distance) over (partition by cluster)::bigint as cluster_inertia,
       sum(distance) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (cluster)
"""


OP12_SQL = _op12_sql()


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_plans(conversation_repair.damage(conversations), conversations)


def _op13_sql() -> str:
    """Least edits from the last row to the first. A value is nine digits of cost and
    the audit, so that the least text is the cheapest and ASCII-least edit; a column
    per node: nothing yet, after s, after u, after a."""

    def then(value: str, cost: str, letter: str) -> str:
        return f"lpad((left({value}, 9)::int + {cost})::varchar, 9, '0') || '{letter}' || substr({value}, 10)"

    def keep(node: str) -> str:
        follows = {"q0": {"s": "q1", "u": "q2"}, "q1": {"u": "q2"}, "q2": {"a": "q3"}, "q3": {"u": "q2"}}[node]
        cases = " ".join(f"when initial = '{i}' then {then(to, 'more', 'K')}" for i, to in follows.items())
        return f"case when gone then '500000000' {cases} else '500000000' end"

    def row(node: str) -> str:
        to = "q3" if node == "q2" else "q2"
        return (
            f"least({then(node, '3', 'D')}, {keep(node)}, "
            f"case when gone then '500000000' else {then(to, '(2 + more)', 'R')} end) as {node}"
        )

    insert = lambda v: then(v, "2", "I")
    return rf"""
with recursive base as (
  select conv_id, turn, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key,
         coalesce(role, ' ') as r, coalesce(text, ' ') as t from conversations
), crc as (
  select conv_id, turn, r, t, xor(list_reduce(
           list_prepend(4294967295::bigint, flatten(list_transform(string_split(key, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
           lambda acc, x: xor(xor(acc, x) >> 1, 3988292384 * (xor(acc, x) & 1))), 4294967295) % 20 as hit
  from base
), damaged as (
  select conv_id, turn, case hit when 4 then 'user' else r end as role,
         case hit when 1 then '' when 2 then regexp_replace(t, '[.!?]', '', 'g') else t end as text,
         unnest(range(case hit when 3 then 2 else 1 end)) as copy
  from crc where hit <> 0
), ordered as (
  select *, row_number() over conv as i, left(role, 1) as initial, lag(left(role, 1)) over conv as before,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as seen
  from damaged window conv as (partition by conv_id order by turn nulls first, role, sha256(text), copy)
), faults as materialized (
  select *, case when seen = '' then 'blank' when again then 'duplicate' when seen in ('.', '!', '?') then 'none' else 'truncated' end as fault
  from ordered
), totals as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal, max(i) as n
  from faults group by conv_id
), walk as (
  select conv_id, n as i, '000000000' as q0, '000000004II' as q1, '000000002I' as q2, '000000000' as q3 from totals
  union all
  select conv_id, i, least(q0, {insert("c2")}), least(q1, {insert("c2")}), c2, least(q3, {insert("q2")})
  from (select *, least(q2, {insert("q3")}) as c2 from (
    select w.conv_id, w.i - 1 as i, {", ".join(row(q) for q in ("q0", "q1", "q2", "q3"))}
    from (select w.*, initial, fault in ('blank', 'duplicate') as gone, (fault = 'truncated')::int as more
          from walk w join faults f on w.conv_id is not distinct from f.conv_id and w.i = f.i) w))
), best as (
  select conv_id, left(q0, 9)::bigint as cost, substr(q0, 10) as audit from walk where i = 0
), letters as (
  select conv_id, p, letter, count(*) filter (letter <> 'I') over run as i, count(*) filter (letter <> 'D') over run as nth
  from (select conv_id, unnest(range(1, length(audit) + 1)) as p, substr(audit, p, 1) as letter from best)
  window run as (partition by conv_id order by p)
), kept as (
  select l.conv_id, p, letter, nth, f.role, case letter when 'I' then '' else f.text end as text,
         max((nth = 1 and letter = 'K' and initial = 's')::int) over (partition by l.conv_id) as system
  from letters l left join faults f on l.conv_id is not distinct from f.conv_id and l.i = f.i where letter <> 'D'
), repaired as (
  select conv_id, sha256(string_agg(
           case when letter = 'K' then role when (nth - system) % 2 = 1 then 'user' else 'assistant' end || ':' || text,
           chr(10) order by p)) as repaired_sha256
  from kept group by conv_id
)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
       coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join totals t on c.conv_id is not distinct from t.conv_id
left join best b on c.conv_id is not distinct from b.conv_id
left join repaired r on c.conv_id is not distinct from r.conv_id
"""


OP13_SQL = _op13_sql()


def llm_queries() -> dict[str, Query]:
    found = (
        op1_exact_dedup, op2_quality_classifier, op3_packing, op4_sentencepiece, op5_token_files,
        op6_embedding_dedup, op7_toxicity, op8_url_filter, op9_minhash_dedup, op10_substring_dedup,
        op11_suffix_dedup, op12_centroid_clustering, op13_conversation_repair,
    )
    return {f.__name__: f for f in found}


def llm_oracles() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1_SQL,
        "op8_url_filter": OP8_SQL,
        "op11_suffix_dedup": OP11_SQL,
        "op12_centroid_clustering": OP12_SQL,
        "op13_conversation_repair": OP13_SQL,
    }
