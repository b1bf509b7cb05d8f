from gleanstar.llm.ngram_join import ngram_jaccard_join
from gleanstar.llm.registry import query, table


@query(
    "op6_ngram_jaccard",
    r"""with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    e as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end as s from d),
    u as (select doc_id, list_distinct(s) as s, len(list_distinct(s)) as n from e),
    x as (select doc_id, n, unnest(s) as t from u),
    p as (select a.doc_id as a, b.doc_id as b from x as a join x as b on a.t = b.t and a.doc_id < b.doc_id
        and a.n * 100 >= b.n * 90 and b.n * 100 >= a.n * 90
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    l as (select a, b from p union select b, a from p),
    r as (select doc_id as a, doc_id as b from u union select r.a, l.b from r join l on r.b = l.a)
    select u.doc_id, u.n as n_shingles, min(r.b) as component_id from u join r on u.doc_id = r.a group by u.doc_id, u.n""",
)
def op6(spark, sf_dir):
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))
