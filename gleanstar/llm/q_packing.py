from gleanstar.llm.packing import pack_documents
from gleanstar.llm.q_token_blocks import WORD_BPE
from gleanstar.llm.registry import query, table


@query("op11_packing")
def op11(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)
