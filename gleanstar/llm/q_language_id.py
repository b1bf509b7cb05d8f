from gleanstar.llm.language_id import language_id
from gleanstar.llm.registry import query, table


@query("op8_language_id")
def op8(spark, sf_dir):
    return language_id(table(spark, sf_dir, "documents"))
