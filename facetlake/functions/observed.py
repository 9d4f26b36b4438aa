"""Figures of the stages of a run, taken while they are written: no pass of their own."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger("facetlake.stages")


class Stages:
    """``watch`` marks a frame that is about to be written; ``figures`` gives what was counted, in the order of the marks.

    A figure waits for its write: asking for one whose frame was never written would wait for ever, so ``figures`` leaves out stages that did not run.
    """

    def __init__(self) -> None:
        self.marks: dict[str, Observation] = {}
        self.done: set[str] = set()

    def watch(self, frame: DataFrame, name: str, **figures: Column) -> DataFrame:
        if name in self.marks:
            raise ValueError(f"stage {name} is watched already")
        self.marks[name] = Observation(name)
        return frame.observe(self.marks[name], F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in figures.items()))

    def ran(self, name: str) -> None:
        """The frame of this stage has been written."""
        self.done.add(name)
        log.info("stage %s: %s", name, self.marks[name].get)

    def figures(self) -> list[tuple[str, dict]]:
        return [(k, m.get) for k, m in self.marks.items() if k in self.done]
