"""The end-to-end chains, each a composition of operators."""

from pyspark.sql import DataFrame

from ..functions import arrays as ar, text as tx
from ..operators import batches as bt, instructions as ins, metrics as mt, pairs, packing as pk
from ..operators.sentences import split_sentences
from ..operators.tokenize import tokenize
from ..operators.vocab import merge_vocab


def extended_vocabulary(
    documents: DataFrame, base: DataFrame, vocab_size=30000, delimiters=tx.DELIMITERS,
    text="text", **training,
) -> DataFrame:
    """Sentences, a vocabulary trained on them, and that appended to `base`."""
    sentences = split_sentences(documents.select(text), text, delimiters)
    return merge_vocab(base, pairs.train_bpe(sentences, vocab_size, **training))


def packed_blocks(
    documents: DataFrame, vocab: DataFrame, order_by: list[str], block_size=pk.BLOCK_SIZE,
    model_max_length: float = float("inf"), mode="bpe", text="text",
    num_shards=pk.NUM_SHARDS, batch_rows=pk.BATCH_ROWS,
) -> DataFrame:
    """Documents (with `split`) to fixed blocks for continued pre-training."""
    length = ar.clamp_length(block_size, model_max_length)
    tokens = tokenize(documents, vocab, text, mode).select("split", *order_by, "input_ids")
    placed = pk.assign_batches(tokens, order_by, num_shards, batch_rows)
    return pk.pack_blocks(placed, order_by, length)


def masked_sequences(
    records: DataFrame, vocab: DataFrame, max_len=ins.MAX_SEQ_LENGTH,
    model_max_length: float = float("inf"), **options,
) -> DataFrame:
    """Instruction records to input ids and masked labels."""
    length = ar.clamp_length(max_len, model_max_length)
    return ins.encode_instructions(records, vocab, max_len=length, **options)


def epoch_batches(
    rows: DataFrame, key: list[str], world_size: int, batch_size: int, epochs: float = 1,
    seed: int = 0, drop_last: bool = True, pad_id: int | None = None, ignore: int = -100,
) -> DataFrame:
    """Prepared rows to batches per epoch and rank, padded when `pad_id` is given."""
    placed = bt.place_batches(
        bt.expand_epochs(rows, epochs), key, world_size, batch_size, drop_last, seed
    )
    if pad_id is None:
        return bt.collate_fixed(placed, group=bt.CHUNK_GROUP).drop("chunk")
    return bt.collate_padded(placed, pad_id, ignore, group=bt.CHUNK_GROUP).drop("chunk")


def evaluation(predictions: DataFrame, ignore_index=None) -> DataFrame:
    return mt.eval_reduce(predictions, ignore_index)
