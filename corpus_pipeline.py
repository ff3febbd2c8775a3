"""Documents to training text: each stage is one operator, written as Parquet and read again as the next one's input."""

from convolake.llm import common, op1_pii, op5_sentencepiece, op8_quality, op9_decontaminate, op10_simhash


def quality(spark, docs, sf_dir):
    """Documents that score as good stay, unchanged; without any label all do."""
    return op8_quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """Of each group the row with the smallest id stays, unchanged; rows without an id can't be told apart and all stay."""
    return op10_simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """All rows stay; words of benchmark passages go from their texts (an empty text may be left), n_chars follows."""
    return op9_decontaminate.remove_spans(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """All rows stay; personal data in their texts becomes the name of its kind, n_chars follows. Null texts stay null."""
    return op1_pii.mask(docs)


def pieces(spark, docs, sf_dir):
    """Token ids of what is left, and whether they decode to it."""
    return op5_sentencepiece.encoded(docs, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("pieces", pieces)]

#: Fingerprints, trained models and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), name)
        if hasattr(before, "stored_path"):
            common.drop_stored(before)
    return docs
