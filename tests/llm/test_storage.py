from __future__ import annotations

from pathlib import Path

from tributary.llm import storage


def test_a_worker_holds_the_cache_of_one_operator():
    dropped = []

    def keeps(name):
        def work(batches):
            for batch in batches:
                storage.keeping(name, lambda: dropped.append(name))
                yield batch

        return storage.tidy(work, name)

    assert list(keeps("first")([1, 2])) == [1, 2]
    assert list(keeps("first")([3])) == [3]
    assert dropped == []
    assert list(keeps("second")([4])) == [4]
    assert dropped == ["first"]
    assert list(storage.tidy(iter)([5])) == [5]
    assert dropped == ["first", "second"]


def test_an_idle_worker_gives_back_the_memory_of_its_texts():
    """Texts of a task lie between objects that stay: without a trim their pages stay with the worker."""

    def resident() -> int:
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096

    texts = [b"x" * (2000 + i % 1000) for i in range(80_000)]
    stay = texts[::1000]
    del texts
    before = resident()
    storage.end_task()
    assert len(stay) == 80 and before - resident() > 100 << 20
