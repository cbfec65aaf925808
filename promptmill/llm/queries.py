"""Registered queries of the subpackage: each applies its operator to a whole given table."""

import public_tokenizers
from pyspark.sql import functions as F

from promptmill.llm import (alignment, chat, exact_dedup, license_scan, mixing, ngram_join, oracles, quality_rules,
                            sentencepiece_codec, sharding, suffix_dedup, token_codes, toxicity, whitening)

from .common import new_folder, table, whole

SHARDS = 16


def op1_slot_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    keys = ["doc_id", "text"]
    size = F.octet_length(whole("text")).cast("long") + 1
    weights = sharding.slot_weights(docs, keys, size)
    first = sharding.first_map(SHARDS)
    second = sharding.rebalanced(first, [b for _, b in weights], SHARDS)
    root = new_folder(spark, "slot-map")
    for version in (first, second):
        sharding.save_map(sharding.map_rows(spark, version, weights), root, version.version)
    placed = sharding.placed(docs, keys, sharding.load_map(spark, root))
    rows = placed.select("doc_id", size.alias("size"), F.crc32(whole("text")).alias("text_crc32"),
                         "shard", "virtual_slot", "offset")
    return sharding.numbered(rows, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op2_content_sort_dedup(spark, sf_dir):
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op3_exponential_mix(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def conversation_records(spark, sf_dir):
    """The rows of conversations as records of four layouts, and conversation -1."""
    awkward = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", awkward), (-1, 1, "assistant", awkward)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(extra)
    said = whole("text")

    def record(**fields):
        return F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()]))

    message = F.struct(F.coalesce("role", F.lit("")).alias("role"), said.alias("content"))
    layouts = (F.when(F.col("role") == "user", record(prompt=said))
               .when(F.col("role") == "assistant", record(response=said))
               .when(F.col("role") == "system", record(instruction=said))
               .otherwise(record(message=message)))
    # every third turn is a list of one message
    layouts = F.when(F.col("turn") % 3 == 2, record(messages=F.array(message))).otherwise(layouts)
    return rows.select("conv_id", "turn", layouts.alias("record"))


def op4_chat_format(spark, sf_dir):
    out = chat.formatted(conversation_records(spark, sf_dir))
    read = out.select("conv_id", "formatted", F.col("formatted").cast("binary").alias("data"),
                      chat.read_turns(F.col("formatted")).alias("turns"), "loss_spans")
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"],
                                                     F.lit("\n")))
    read = read.withColumn("loss", chat.loss_text(F.col("data"), F.col("loss_spans")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_suffix_sort_dedup(spark, sf_dir):
    out = suffix_dedup.removed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_quality(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_lines", "left_chars")


def op7_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op8_max_plus_sentencepiece(spark, sf_dir):
    """Ids of every document by their hash, and the text read back from them."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encoded_and_decoded(
        table(spark, sf_dir, "documents"), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"), "n_chunks",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.sha2("text", 256)).alias("round_trip"))


def op9_license_scan(spark, sf_dir):
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op10_direct_codes(spark, sf_dir):
    return token_codes.encoded_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json")).drop("part", "seq")


def op11_lanczos_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_interval_alignment(spark, sf_dir):
    """Byte-level words against pieces; links are tokens that end together."""
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_50k.json"), pieces,
                             alignment.piece_count(pieces), rule="end")


def op13_text_cnn_toxicity(spark, sf_dir):
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_slot_shards, op2_content_sort_dedup, op3_exponential_mix, op4_chat_format,
    op5_suffix_sort_dedup, op6_line_quality, op7_ngram_jaccard_join, op8_max_plus_sentencepiece, op9_license_scan, op10_direct_codes,
    op11_lanczos_whitening, op12_interval_alignment, op13_text_cnn_toxicity)}

# op1 needs crc32, op5 and op7 have no SQL form of bearable cost, and op8 and op10 to op13 none at
# all: see tests/llm
ORACLE = {"op2_content_sort_dedup": oracles.OP2, "op3_exponential_mix": oracles.OP3,
          "op4_chat_format": oracles.OP4, "op6_line_quality": oracles.OP6,
          "op9_license_scan": oracles.OP9}
