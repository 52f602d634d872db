"""What a scratch folder's release asks of the JVM."""

from types import SimpleNamespace

from gleanery.llm import tables


def test_settling_collects_twice_with_a_wait_before_each(monkeypatch):
    done = []
    system = SimpleNamespace(gc=lambda: done.append("gc"))
    scratch = object.__new__(tables.Scratch)
    scratch.spark = SimpleNamespace(_jvm=SimpleNamespace(System=system))
    monkeypatch.setattr(tables.time, "sleep", lambda s: done.append(s))
    scratch.release(settle=True)
    assert done == [tables.SETTLE, "gc"] * 2
    done.clear()
    scratch.release()
    assert done == ["gc"]
