"""The pipeline on the smallest tables: every stage's decisions hold, and its columns are those of documents."""

import corpus_pipeline
from pitspark.llm import decontaminate, jaccard
from pitspark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
        assert docs.columns == columns, name
        assert docs.select("doc_id").distinct().count() == docs.count() <= before
        before = docs.count()
    assert decontaminate.contaminated(docs, table(spark, SF, "benchmark")).count() == 0
    assert jaccard.JaccardJoin(docs).links.count() == 0
    assert corpus_pipeline.run(spark, SF).count() == before
