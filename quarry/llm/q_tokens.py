"""op4: token ids of ``documents`` written to and read back from Arrow files."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import token_files as tf
from quarry.llm.registry import register
from quarry.session import read_table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


@register("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the stream of all ids, and their checksum, read from the
    files that were written."""
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    folder = tf.new_folder(spark)
    manifest = tf.write_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"), folder, spec, END_ID)
    rows = tf.with_global_start(tf.read_documents(spark, folder, manifest), manifest)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32", "shard")
