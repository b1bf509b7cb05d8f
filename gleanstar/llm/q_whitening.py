from gleanstar.llm.registry import query, table
from gleanstar.llm.whitening import whitened_components


@query("op13_whitening")
def op13(spark, sf_dir):
    return whitened_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
