import uuid

from tessera.sources import text
from tessera.streaming import read_lines_stream


def test_parsers_apply_to_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id_1,id_2,x\n1,2,0.5,?,1,1,1,1,1,1,1,true\n3,4,1,1,1,1,1,1,1,1,1,false\n")
    data, _ = text.split_header(read_lines_stream(spark, str(src)))
    name = "pairs_" + uuid.uuid4().hex[:8]
    q = (
        text.parse_scored_pairs(data)
        .writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = sorted(spark.table(name).collect())
    assert [r.id1 for r in rows] == [1, 3] and rows[0].scores[1] is None
