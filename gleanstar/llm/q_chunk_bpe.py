from gleanstar.llm.chunk_bpe import chunk_bpe
from gleanstar.llm.q_token_blocks import WORD_BPE
from gleanstar.llm.registry import query, table


@query("op2_chunk_bpe")
def op2(spark, sf_dir):
    return chunk_bpe(table(spark, sf_dir, "documents"), WORD_BPE)
