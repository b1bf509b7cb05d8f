from pyspark.sql import functions as F

from gleanstar.llm.license_scan import license_scan
from gleanstar.llm.registry import query, table


@query("op10_license_scan")
def op10(spark, sf_dir):
    out = license_scan(table(spark, sf_dir, "documents"))
    out = out.withColumn("licenses", F.array_join("licenses", ",")).withColumn("families", F.array_join("families", ","))
    return out.withColumn("dice", F.round("dice", 6))
