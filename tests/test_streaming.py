from pyspark.sql import functions as F

import sangam as S


def test_column_functions_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("see https://x.y @me hello there\n\n<3 <3 <3\n")
    lines = spark.readStream.schema("value string").text(str(tmp_path / "in"))
    cleaned = S.with_script(lines.select(S.clean_text(F.col("value")).alias("text")))
    query = cleaned.writeStream.format("memory").queryName("cleaned_stream").start()
    try:
        query.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table("cleaned_stream").collect())
    finally:
        query.stop()
    assert got == [("", "unknown"), ("<3 <3 <3", "unknown"), ("see hello there", "roman_only")]
