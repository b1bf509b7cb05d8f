from pyspark.sql import functions as F

from gleanstar.llm.decontaminate import decontaminate
from gleanstar.llm.registry import query, table

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op4_decontaminate",
    f"""with i as (select item_id, {_WORDS} as w from benchmark),
    x as (select distinct item_id, unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda p: w[p : p + 9])) as v from i where len(w) > 0),
    y as (select item_id, v, len(v) as k, list_aggregate(v, 'string_agg', ' ') as key from x),
    d as (select doc_id, {_WORDS} as w from documents),
    z as (select doc_id, p, k, list_aggregate(w[p : p + k - 1], 'string_agg', ' ') as key
        from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, (select distinct k from y))),
    o as (select z.doc_id, z.p, z.k, y.item_id from z join y on z.key = y.key and z.k = y.k),
    h as (select doc_id, count(distinct q) as n from (select doc_id, unnest(range(p, p + k)) as q from o) group by doc_id),
    m as (select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct doc_id, cast(item_id as varchar) as item_id from o) group by doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(h.n, 0) as n_hit, coalesce(m.n, 0) as n_items,
        sha256(coalesce(m.ids, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
    from d left join h on d.doc_id = h.doc_id left join m on d.doc_id = m.doc_id""",
)
def op4(spark, sf_dir):
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")
