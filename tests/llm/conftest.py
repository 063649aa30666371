import pytest


@pytest.fixture
def spread(spark):
    """Small shuffles keep their partitions, so that groups cross partition borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
