from gleanstar.llm.ngram_trie import lm_scores
from gleanstar.llm.registry import query, table


@query("op5_lm_scores")
def op5(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"))
