"""A worker that waits for later stages does not hold what its last task needed at its most."""

from pathlib import Path

from fundlens.llm.common import tidy


def resident_mb() -> float:
    pages = int(Path("/proc/self/statm").read_text().split()[1])
    return pages * 4096 / 1e6


def test_a_finished_task_gives_its_memory_back():
    pinned = []

    def run(batches):
        held = [bytes(2000) for _ in range(100_000)]
        pinned.append(bytes(2000))  # above the rest, so that the C library alone keeps it all
        yield from batches
        held.clear()

    before = resident_mb()
    assert list(run([1])) == [1]
    assert resident_mb() - before > 150  # as it was
    assert list(tidy(run)([1, 2])) == [1, 2]
    assert resident_mb() - before < 50
