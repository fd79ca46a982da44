"""Operations and delay analytics on Spark: DataFrames in, DataFrames out."""

from delaylens.session import checkpointed, configure, workspace

__all__ = ["checkpointed", "configure", "workspace"]
