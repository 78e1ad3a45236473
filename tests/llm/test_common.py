"""Tables between steps."""

import glob

import pyarrow.parquet as pq

from quotemill.llm.common import staged


def test_tables_between_steps_are_written_with_zstd(spark):
    rows = staged(spark.createDataFrame([(i, "word " * 50) for i in range(100)], "doc_id long, text string"), "t")
    folder = rows.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(c).compression for f in glob.glob(f"{folder}/*.parquet")
              for c in (0, 1) if pq.ParquetFile(f).metadata.num_row_groups}
    assert codecs == {"ZSTD"}
    assert rows.count() == 100
