"""Item embeddings end to end: from sequences to trained vectors, with every rule in its order."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from ..sources import readers, sinks
from . import sequences, sgns

MODES = ("embed", "softmax", "avg")


@dataclass
class Trained:
    """Vectors and what they were made with."""

    vectors: DataFrame  # node, embed, softmax
    losses: DataFrame  # epoch, loss
    info: dict = field(default_factory=dict)
    replace_value: str | None = None

    def embeddings(self, mode: str = "embed", keep_replace_value: bool = False) -> DataFrame:
        """``node``, ``embedding`` of a mode; the replacement token is left out unless asked for."""
        rows = sgns.read_vectors(self.vectors, mode)
        return rows if keep_replace_value or self.replace_value is None else rows.where(F.col("node") != self.replace_value)

    def save(self, folder: str, stamp: str, mode: str = "embed", keep_replace_value: bool = False) -> list[str]:
        """Embeddings as text and the model's facts as JSON; a mode that isn't one of the three writes all."""
        return sinks.export_model({m: self.embeddings(m, keep_replace_value) for m in MODES}, folder, stamp, mode, self.info)


@dataclass
class Item2Vec:
    """Settings of a run. Defaults and names are those that users of such models know."""

    embed_dim: int = 128
    window_size: int = 10
    random_window: bool = False
    distinct_targets: bool = False
    item_min_count: int | None = 3
    item_max_count: int | None = None
    item_filter_method: str = "replace"
    item_replace_value: str = "<zero>"
    train_with_replace_value: bool = True
    seq_min_len: int = 3
    seq_max_len: int | None = 200
    seq_truncate_method: str = "left"
    n_sampled: int = 10
    ns_method: str = "sampled_softmax"
    ns_remove_accidental_hits: bool = True
    subsample: bool = True
    subsample_thr: float = 1e-5
    lr: float | None = None
    name: str = "Item2Vec"
    seed: int = 7
    parts: int | None = None

    def _pairs(self, indexed: DataFrame) -> DataFrame:
        window = sequences.random_window(self.window_size, self.seed) if self.random_window else self.window_size
        return sequences.skip_grams(indexed, window, self.distinct_targets, self.train_with_replace_value or self.item_filter_method != "replace")

    def train(self, feed: DataFrame | str, feed_type: str = "list", epochs: int = 10, batch_size: int = 128, shuffle: bool = True, item_pools: DataFrame | list | None = None, ns_sampled_values: tuple | None = None, spark: SparkSession | None = None) -> Trained:
        """Truncates, counts, filters, numbers, subsamples and pairs the sequences, then trains.

        ``feed``: ``seq_id``, ``items`` (array<string>), or the path of a text file
        of one comma-separated sequence a line. As ``list``, items are subsampled
        once and a batch is ``batch_size`` pairs; as ``file``, they are subsampled
        anew each epoch, and a batch is the pairs of ``batch_size`` sequences in
        the order of ``seq_id``. ``item_pools`` (a frame with ``item``, or a list) replaces
        the vocabulary. Sequences shorter than ``seq_min_len`` go; without any
        sequence there are no vectors but that of the replacement token.
        """
        if feed_type not in ("list", "file"):
            raise ValueError(f"feed type: {feed_type}")
        if isinstance(feed, str):
            feed = cut(readers.sequences(spark or SparkSession.active(), feed).select(F.monotonically_increasing_id().alias("seq_id"), "items"))
        method = self.item_filter_method
        seqs = cut(sequences.truncate(feed, self.seq_min_len, self.seq_max_len, self.seq_truncate_method))
        pool = item_pools
        if isinstance(pool, (list, tuple)):
            pool = seqs.sparkSession.createDataFrame([(str(x),) for x in pool], "item string")
        vocab = cut(sequences.vocabulary(sequences.item_counts(seqs), self.item_min_count, self.item_max_count, pool))
        indexed = cut(sequences.index_sequences(seqs, vocab, method))
        keep = sequences.keep_probability(vocab, self.subsample_thr)

        def pairs(epoch: int) -> DataFrame:
            return self._pairs(sequences.subsample(indexed, keep, self.seed, method, epoch) if self.subsample else indexed)

        by_file = feed_type == "file"
        replaced = self.item_replace_value if method == "replace" else None
        vectors, losses = sgns.train(
            pairs if by_file and self.subsample else pairs(0), vocab, self.embed_dim, epochs, batch_size, self.n_sampled, self.ns_method, self.lr, self.parts, self.seed,
            shuffle and not by_file, self.ns_remove_accidental_hits, ns_sampled_values, by_file, replaced,
        )
        history = [r.loss for r in losses.orderBy("epoch").collect()]  # a number for each epoch
        info = asdict(self) | {"epochs": epochs, "batch_size": batch_size, "shuffle": shuffle, "history_loss": history}
        return Trained(vectors, losses, info, replaced)
