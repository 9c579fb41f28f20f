import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs_of(spark):
    """documents from (doc_id, text[, lang, source]) rows, in 3 partitions,
    with extra columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a",
                 len(r[1] or "")) for r in rows]
        from pyspark.sql import functions as F
        df = spark.createDataFrame(full, DOCS)
        return df.repartition(3).withColumns({
            "key": F.lit("x"), "kept": F.lit(1), "label": F.lit(None).cast("string"),
            "size": F.lit("s"), "row": F.lit(2.0), "node": F.lit("n"), "start": F.lit("q"),
            "part": F.lit("p"), "target": F.lit(0), "epochs": F.lit("e"), "held": F.lit(1.5),
            "source_size": F.lit(None).cast("int"), "keep_id": F.lit("k"), "component_id": F.lit(3),
            "rank": F.lit("r"), "gone": F.lit("g"), "weight": F.lit("w"), "cell": F.lit(1),
            "band": F.lit("b"), "digest": F.lit("d"), "context": F.lit("c"), "value": F.lit(9),
            "h": F.lit(True), "tie": F.lit("t"), "score": F.lit("z"), "_key": F.lit(7),
            "_id": F.lit("i"), "_kept_key": F.lit(8), "_gone": F.lit(None).cast("double"),
            "_language": F.lit("none"), "language": F.lit(2), "id": F.lit("j"), "by_id": F.lit(1),
            "_doc": F.lit("d"), "of": F.lit(0), "first": F.lit("f"), "n": F.lit(4)})
    return make
