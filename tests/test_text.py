from riskwise.functions.text import labelled_documents
from riskwise.session import table

from .conftest import SF_SMALL

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def test_both_join_paths_agree(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    joined = labelled_documents(docs, labels)
    cols = sorted(joined.columns)
    small = sorted(joined.select(cols).collect())                # labels under the planner's broadcast threshold
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        large = sorted(labelled_documents(docs, labels).select(cols).collect())   # shuffle join
    finally:
        spark.conf.set(THRESHOLD, before)
    assert small == large
    assert len(small) == labels.join(docs, "doc_id").count()
