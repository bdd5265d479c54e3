from quirefold.streaming.verses import arriving_findings

VERSE = "paper int, section int, verse int, text string, italics array<struct<s:int,e:int>>"


def test_arriving_findings(spark, tmp_path):
    rows = [(1, 1, 1, "same  text", []), (1, 1, 2, "new", []), (1, 1, 3, "lean", [(0, 4)]), (1, 1, 4, "other", []), (1, 1, 5, "allowed", [])]
    spark.createDataFrame(rows, VERSE).write.parquet(str(tmp_path / "in"))
    stored = spark.createDataFrame([(1, 1, 1, "same text", []), (1, 1, 3, "lean", []), (1, 1, 4, "others", []), (1, 1, 5, "x", [])], VERSE)
    allow = spark.createDataFrame([(1, 1, 5, True, False)], "paper int, section int, verse int, skip boolean, ignore_italics boolean")
    stream = spark.readStream.schema(VERSE).parquet(str(tmp_path / "in"))
    q = arriving_findings(stream, stored, allow).writeStream.format("memory").queryName("findings").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.verse, r.status) for r in spark.table("findings").collect()} == {(2, "only_left"), (3, "italic"), (4, "text")}
