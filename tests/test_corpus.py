"""One file per document: the files are written by several tasks, also from a table in one piece."""

import glob
import os

from mlspark import catalog
from mlspark.session import shared_dir


def test_documents_are_written_by_several_tasks(spark, sf):
    before = set(glob.glob(f"{shared_dir(spark)}/corpus-*"))
    catalog.load_all()
    rows = catalog.QUERIES["I3_read_corpus"](spark, sf)
    assert rows.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    (path,) = set(glob.glob(f"{shared_dir(spark)}/corpus-*")) - before
    assert len({os.path.basename(f)[:10] for f in glob.glob(f"{path}/doc_id=*/part-*")}) > 1
