"""Session settings for large inputs."""

from __future__ import annotations

MIB = 1024 * 1024


def recommended_conf(
    input_bytes: int, partition_bytes: int = 256 * MIB, state_partitions: int | None = None
) -> dict[str, str]:
    """Settings for a session that reads about ``input_bytes`` of messages.

    Adaptive execution merges small shuffle partitions and splits skewed ones, but
    starts from a number it is told. That number has to grow with the input: the
    deduplication shuffles about as much as it reads, and two hundred partitions of
    100 TB would be half a terabyte each. ``state_partitions`` is for streams whose state
    needs another number than the batch.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        # for streaming state, which is never merged or split
        "spark.sql.shuffle.partitions": str(state_partitions or partitions),
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        # streaming state on disk, not on the heap
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
