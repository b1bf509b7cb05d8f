from gleanstar.llm.registry import query, table
from gleanstar.llm.repair import damage, repair_conversations


@query("op12_conversation_repair")
def op12(spark, sf_dir):
    return repair_conversations(damage(table(spark, sf_dir, "conversations")), times_col="times")
