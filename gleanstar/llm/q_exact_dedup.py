from gleanstar.llm.exact_dedup import exact_dedup
from gleanstar.llm.registry import query, table


@query(
    "op9_exact_dedup",
    """with d as (select doc_id, coalesce(text, '') as t from documents)
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
        doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
    from d window w as (partition by t)""",
)
def op9(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
