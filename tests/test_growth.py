"""Plans whose work must grow no faster than their rows."""

from pyspark.sql import functions as F

from framewright.operators import masks, series
from framewright.plans import stages


def pixels(spark):
    return spark.range(40).select(
        F.lit(1).cast("long").alias("k"), "id", F.col("id").alias("i"), F.lit(0).alias("y"), F.lit(0).alias("x"), F.col("id").alias("v"), (F.col("id") % 4 != 1).alias("m"), (F.col("id") % 3 == 0).alias("logo"), F.lit(False).alias("logo_removed")
    )


def test_next_clean_values_come_from_frames_that_begin_at_a_border(spark):
    # A frame that ends at a series' end is gone through anew for each row.
    df = pixels(spark)
    plans = [
        masks.remove_logos(df.drop("m", "logo"), df.select("k", "i", "y", "x", F.col("logo").alias("m")), ["k"]), series.clean_neighbours(df, ["k"]), stages.Chain().then("logos").run(df),
    ]
    for found in plans:
        assert "currentrow$(), unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.backward_i for r in series.clean_neighbours(df, ["k"], bucket=8).orderBy("i").collect()] == [min((j for j in range(i, 40) if j % 4 == 1), default=39) for i in range(40)]
