"""Write-ahead commit of batch windows.

A job that publishes a window first records its intent, then stages its whole result
where no reader looks, then records that it is staged, then applies the staged
copy to the target, then records that it is applied.  The caller records the
window in the state table and closes the entry.  A run that finds an entry goes
on where the last one stopped:

* an intent without a staged record: nothing was published; what was staged is removed
  and the window is computed anew;
* staged but not applied: the same staged copy is applied again, never recomputed
  from a target that may already hold half of it;
* applied but not recorded in the state: nothing is applied a second time.

``apply`` must therefore give the same target however often and however far it ran
before: overwriting partitions with the staged ones, pointing to a staged version,
or adding staged rows whose keys aren't there.  One driver at a time may run a
job of one state table (a scheduler's rule); two that merged into the same
version of a target are told apart by its sequence number, not here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from usagetally.sources.files import names_in, read_record, remove, write_record


def step(name: str, **what) -> None:
    """Called between the steps of a commit: ``intent``, ``staged``, ``published``, ``applied``.

    Does nothing; tests and the recovery queries put a failure here."""


class Journal:
    """The entries of one job below ``root``, a folder that all drivers of the job see."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def pending(self) -> list[str]:
        """Windows with an entry that is not closed."""
        return names_in(self.spark, self.root)

    def record(self, window: str, name: str) -> dict | None:
        return read_record(self.spark, f"{self.root}/{window}/{name}")

    def _put(self, window: str, name: str, record: dict) -> None:
        write_record(self.spark, f"{self.root}/{window}/{name}", record)

    def commit(self, window: str, intent: dict, stage: Callable[[str], dict], apply: Callable[[dict, bool], None],
               undo: Callable[[dict], None] | None = None) -> dict:
        """Publish ``window`` once; returns the staged record.

        ``intent``: JSON values known before the work, such as the target and the name of a version to
        be written.  ``stage(folder)`` writes the result and returns JSON values that ``apply`` needs.
        ``apply(staged, again)`` publishes it; ``again`` is true if an earlier run may have begun to.
        ``undo(intent)`` removes what an unfinished ``stage`` left outside the entry's folder."""
        staged, again = self.record(window, "staged"), True
        if staged is None:
            again = False
            left = self.record(window, "intent")
            if left is not None and undo is not None:
                undo(left)
            remove(self.spark, f"{self.root}/{window}")
            self._put(window, "intent", intent)
            step("intent", window=window)
            staged = stage(f"{self.root}/{window}/data")
            self._put(window, "staged", staged)
            step("staged", window=window, staged=staged)
        if self.record(window, "applied") is None:
            apply(staged, again)
            step("published", window=window)
            self._put(window, "applied", {"window": window})
            step("applied", window=window)
        return staged

    def close_unstaged(self, window: str, undo: Callable[[dict], None] | None = None) -> None:
        """Forget a window of which nothing is staged; ``undo`` as in ``commit``."""
        left = self.record(window, "intent")
        if left is not None and undo is not None:
            undo(left)
        self.close(window)

    def close(self, window: str) -> None:
        """Forget a window that the state table has recorded (or that was refused)."""
        remove(self.spark, f"{self.root}/{window}")


def once(spark: SparkSession, name: str) -> Journal:
    """A journal for a job that runs outside the batch runner: its entries go when it ends."""
    from usagetally.session import scratch_path
    return Journal(spark, scratch_path(spark, f"journal-{name}"))


__all__ = ["Journal", "once", "step"]
