"""Model calls that survive a killed task: replies stored as they come."""

import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsgraph.operators import annotate as A
from newsgraph.operators import replies as R


class Killed(BaseException):
    """Not an error of the call: the worker goes down."""


class Client:
    def __init__(self, log, kill_after=None):
        self.log, self.kill_after = log, kill_after

    def complete(self, system, prompt, max_tokens):
        if self.kill_after is not None and len(self.log) >= self.kill_after:
            raise Killed
        if prompt.endswith("bad"):
            raise RuntimeError("busy")
        self.log.append(prompt)
        return prompt.upper()


def _batches(n, keys):
    frame = pd.DataFrame({"prompt_key": keys, "prompt": [f"p{i}" + ("bad" if i == 5 else "") for i in range(n)]})
    return iter([frame.iloc[:n // 2], frame.iloc[n // 2:]])


def test_a_killed_task_sends_only_its_unfinished_prompts(monkeypatch, tmp_path):
    monkeypatch.setattr(R, "FLUSH_REPLIES", 4)
    store, n = R.ReplyStore(f"file://{tmp_path}/store"), 40
    keys = [f"{i:08x}{'0' * 56}" for i in range(n)]
    first, second = [], []
    spec = A.CallSpec("s", in_flight=1)
    with pytest.raises(Killed):
        list(A._call_batches(lambda: Client(first, 17), spec, store)(_batches(n, keys)))
    out = pd.concat(A._call_batches(lambda: Client(second), spec, store)(_batches(n, keys)))
    assert len(first) == 17 and not set(first) & set(second) and len(first) + len(second) == n - 1
    assert out.prompt_key.tolist() == keys
    assert [r for r in out.reply if r] == [f"P{i}" for i in range(n) if i != 5] and out.error.notna().sum() == 1


def test_a_later_run_sends_new_and_failed_prompts_only(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()

    class Logged:
        def __init__(self, fail):
            self.fail = fail

        def complete(self, system, prompt, max_tokens):
            if self.fail and prompt.endswith("3"):
                raise RuntimeError("busy")
            with open(folder / prompt, "a") as f:
                f.write("x")
            return prompt

    store = str(tmp_path / "store")

    def run(n, fail):
        df = spark.range(n).select(F.col("id"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("p"))
        return A.call_model(df, F.col("p"), lambda: Logged(fail), A.CallSpec("s"), partitions=3, store=store).collect()

    out = run(30, True)
    assert sorted(r.id for r in out if r.error) == [3, 13, 23]
    out = run(40, False)
    assert all(r.reply == r.p and r.error is None for r in out) and len(out) == 40
    assert all(f.read_text() == "x" for f in folder.iterdir()) and len(list(folder.iterdir())) == 40


def test_calls_in_flight_are_bounded_and_share_one_limit():
    now, most, starts, lock = [0], [0], [], threading.Lock()

    class Slow:
        def complete(self, system, prompt, max_tokens):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
                starts.append(time.monotonic())
            time.sleep(0.05)
            with lock:
                now[0] -= 1
            return prompt

    frame = pd.DataFrame({"prompt_key": [str(i) for i in range(12)], "prompt": [str(i) for i in range(12)]})
    out = pd.concat(A._call_batches(Slow, A.CallSpec("s", in_flight=3, min_interval=0.02))(iter([frame])))
    assert out.reply.tolist() == frame.prompt.tolist() and 1 < most[0] <= 3
    assert min(b - a for a, b in zip(sorted(starts), sorted(starts)[1:])) > 0.015


def test_key_parts_cover_all_keys(spark):
    keys = [f"{i * 2654435761 % (1 << 32):08x}ff" for i in range(500)] + ["00000000aa", "ffffffffaa"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", R.key_part_column("k", 7).alias("p"))
    assert all(r.p == R.key_part(r.k, 7) for r in df.collect()) and {R.key_part(k, 7) for k in keys} == set(range(7))


def test_only_failures_are_written_beside_the_store(spark, monkeypatch, tmp_path):
    """What the tasks have stored is not written a second time."""
    from newsgraph.operators import annotate as A

    class Some:
        def complete(self, system, prompt, max_tokens):
            if prompt.endswith("3"):
                raise RuntimeError("busy")
            return prompt.upper()

    written, materialize = {}, A.materialize

    def watch(df, name):
        out = materialize(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(A, "materialize", watch)
    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "i long, p string")
    got = A.call_model(df, F.col("p"), Some, A.CallSpec("s"), partitions=3, store=str(tmp_path / "store")).collect()
    assert {r.i: (r.reply, r.error) for r in got} == {
        i: (None, "RuntimeError: busy") if i % 10 == 3 else (f"P{i}", None) for i in range(20)}
    assert written["replies"] == 2


@pytest.mark.parametrize("most", [0, 500_000])
def test_a_later_run_is_the_same_whether_the_keys_left_are_few(spark, monkeypatch, tmp_path, most):
    from newsgraph.operators import annotate as A

    class Some:
        def __init__(self, fail):
            self.fail = fail

        def complete(self, system, prompt, max_tokens):
            if prompt in self.fail:
                raise RuntimeError("busy")
            return prompt.upper()

    monkeypatch.setattr(A, "LEFT_KEYS", most)
    store = str(tmp_path / "store")
    df = spark.createDataFrame([(i, f"p{i // 2}") for i in range(20)], "i long, p string")
    for fail in ({"p1", "p4"}, {"p4"}, set()):
        got = A.call_model(df, F.col("p"), lambda f=fail: Some(f), A.CallSpec("s"), partitions=3, store=store).collect()
        assert {r.i: (r.reply, r.error is None) for r in got} == {
            i: (None, False) if f"p{i // 2}" in fail else (f"P{i // 2}", True) for i in range(20)}
