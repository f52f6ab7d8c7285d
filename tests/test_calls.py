"""Bounded calls: how many are under way, order, retries, a wait for all after a refusal; model runners and a judge over the seam."""

import asyncio
import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarrymill.operators import evaluate
from quarrymill.sources import connectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def counting(kind):
    """A connector that tells how many calls of its task are under way; async or plain."""
    state = {"now": 0, "lock": threading.Lock()}

    def begin():
        with state["lock"]:
            state["now"] += 1
            return state["now"]

    def end():
        with state["lock"]:
            state["now"] -= 1

    async def call(request):
        n = begin()
        await asyncio.sleep(0.02 if int(request) % 3 else 0.06)
        end()
        if int(request) % 10 == 7:
            raise connectors.CallError(400)
        return f"{request}:{n}"

    def plain(request):
        n = begin()
        time.sleep(0.02 if int(request) % 3 else 0.06)
        end()
        if int(request) % 10 == 7:
            raise connectors.CallError(400)
        return f"{request}:{n}"

    return call if kind == "async" else plain


@pytest.mark.parametrize("kind", ["async", "plain"])
def test_in_flight_and_order(spark, kind):
    requests = spark.range(60).select("id", F.col("id").cast("string").alias("q"))
    out = connectors.answered(requests, "q", lambda: counting(kind), concurrency=1, in_flight=5)
    rows = out.collect()
    assert [r["id"] for r in rows] == [r["id"] for r in requests.repartition(1).collect()]
    most = max(int(r["answer"].split(":")[1]) for r in rows if r["answer"])
    assert 1 < most <= 5
    assert all((r["answer"] is None) == (r["id"] % 10 == 7) and (r["answer"] or f"{r['id']}:").startswith(f"{r['id']}:") for r in rows)
    assert {r["error"] for r in rows if r["id"] % 10 == 7} == {"call failed with 400"}
    one = connectors.answered(requests.where("id < 8"), "q", lambda: counting(kind), concurrency=1).collect()
    assert {r["answer"].split(":")[1] for r in one if r["answer"]} == {"1"}


def test_refusal_holds_all():
    """After a 429 no call of the task begins before its wait is over."""
    begun, refused = [], []

    async def call(request):
        begun.append(time.monotonic())
        if request == "0" and not refused:
            refused.append(time.monotonic())
            raise connectors.CallError(429, 0.3)
        await asyncio.sleep(0.01)
        return request

    async def main():
        gate = connectors._Gate(2)
        return await asyncio.gather(*(connectors._called(call, str(i), connectors.Retry(3), gate, asyncio.sleep, None) for i in range(6)))

    assert asyncio.run(main()) == [str(i) for i in range(6)]
    assert len(begun) == 7 and sum(refused[0] + 0.02 < t < refused[0] + 0.29 for t in begun) == 0


def test_runners_and_judge(spark):
    tasks = spark.createDataFrame([(1, "good paper"), (2, "bad paper"), (3, "odd paper")], "sample_id int, content string")

    def shout():
        def call(prompt):
            if "bad" in prompt:
                raise connectors.CallError(400)
            return prompt.upper()

        return call

    async def whisper(prompt):
        return prompt[:3]

    outputs = connectors.model_outputs(tasks, "content", {"loud": shout, "soft": lambda: whisper, "gone": None}, concurrency=2)
    got = {(r["sample_id"], r["model"]): r["output"] for r in outputs.collect()}
    assert got[1, "loud"] == "GOOD PAPER" and got[2, "loud"] == "[Error: call failed with 400]" and got[3, "soft"] == "odd" and got[1, "gone"] == evaluate.NO_MODEL
    assert len(got) == 9

    def judge():
        def call(prompt):
            if "odd" in prompt:
                return "no opinion"
            return 'I say {"winner": "model_a", "model_a": {"total": 9}, "seen": "%s"}' % prompt.split("|")[1]

        return call

    asked = outputs.where("model <> 'gone' OR sample_id = 2")
    judged = {r["sample_id"]: r for r in connectors.judged_outputs(asked, ["loud", "soft"], "judge {output_a}|{output_b}", judge, concurrency=1).collect()}
    assert set(judged) == {1, 3} and '"seen": "goo"' in judged[1]["evaluation"] and judged[3]["raw"] == "no opinion" and judged[3]["error"]
    assert {r["model"]: (r["wins"], r["avg_score"]) for r in evaluate.judge_summary(connectors.judged_outputs(asked, ["loud", "soft"], "judge {output_a}|{output_b}", judge, concurrency=1), "evaluation", ["model_a", "model_b"]).collect()} == {"model_a": (1, 9.0), "model_b": (0, 0.0)}
