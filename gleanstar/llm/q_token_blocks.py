import public_tokenizers

from gleanstar.llm.registry import query, table
from gleanstar.llm.token_blocks import token_blocks

# A vocabulary file that the machines that run the tasks have as well.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op7_token_blocks")
def op7(spark, sf_dir):
    return token_blocks(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)
