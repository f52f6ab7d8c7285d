"""truncate_smart reads whole documents."""

import random
import re

from quarrymill.plans import catalog


def test_truncate_smart_whole_text(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", "abc"] + ["".join(rng.choices("abcdefgh", k=n)) for n in (4, 1999, 2003, 5001, 9999)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    papers = {r["doc_id"]: r["paper"] for r in catalog._paper(spark, str(tmp_path)).collect()}
    assert [p and re.sub(r"\n## \w+\n", "", p) for p in (papers[i] for i in range(len(texts)))] == [None, *texts[1:]]
    got = {r["doc_id"]: r["text"] for r in catalog.truncate_smart(spark, str(tmp_path)).collect()}
    assert got[6].startswith("## Abstract\n" + texts[6][:1000] + "\n\n## Introduction\n" + texts[6][1000:1400])
    assert got[7].startswith("## Abstract\n" + texts[7][:1480])
