from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tallymark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
