from gleanstar.llm.line_dedup import line_dedup
from gleanstar.llm.registry import query, table


@query(
    "op3_line_dedup",
    r"""with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from d),
    k as (select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
    c as (select key, max(doc_id) as largest from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
    m as (select k.*, c.largest is not null and k.doc_id <> c.largest as lost from k left join c on k.key = c.key)
    select doc_id, count(*) as n_lines, count(*) filter (where lost) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
    from m group by doc_id""",
)
def op3(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents")).drop("keep_bitmap")
