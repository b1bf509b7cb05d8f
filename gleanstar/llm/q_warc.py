from gleanstar.llm.registry import query, table
from gleanstar.llm.warc import round_trip


@query(
    "op1_warc",
    """with p as (select page_id, coalesce(html, '') as t from pages),
    f as (select *, min(page_id) over (partition by t) as first, sha1(t) as h from p)
    select page_id, cast(octet_length(encode(t)) as bigint) as payload_bytes,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            cast(((cast('0x' || substr(h, 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31) + 1 as bigint), 1)), '') as payload_digest,
        case when page_id = first then 'response' else 'revisit' end as record_type,
        case when page_id <> first then first end as refers_to
    from f""",
)
def op1(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages"), min_bytes=0).drop("url")
