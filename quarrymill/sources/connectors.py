"""The seam to services: models, parsers, judges. A connector is a function of one request; none is called but the caller's own."""

from __future__ import annotations

import asyncio
import inspect
import time
from collections.abc import Callable, Iterator
from concurrent.futures import Executor, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.scan import backoff_seconds


class CallError(Exception):
    """A failed call: an HTTP status (null for a timeout), and what the service asked to wait."""

    def __init__(self, status: int | None, retry_after: float | None = None):
        super().__init__(f"call failed with {status}")
        self.status, self.retry_after = status, retry_after


@dataclass(frozen=True)
class Retry:
    tries: int = 3
    base: float = 1.0
    most: float = 60.0


def called(call: Callable[[str], str], request: str, retry: Retry, sleep=time.sleep) -> str:
    """call(request), repeated after errors that pass; the last error is raised."""
    for attempt in range(retry.tries):
        try:
            return call(request)
        except CallError as e:
            wait = backoff_seconds(attempt, e.status, e.retry_after, retry.base, retry.most)
            if wait is None or attempt == retry.tries - 1:
                raise
            sleep(wait)
    raise CallError(None)


async def _slept(sleep, seconds: float) -> None:
    waits = sleep(seconds)
    if inspect.isawaitable(waits):
        await waits


class _Gate:
    """What a task's calls share: at most so many at once, and after a refusal (429) a wait for all of them."""

    def __init__(self, in_flight: int):
        self.slots, self.until = asyncio.Semaphore(in_flight), 0.0

    def hold(self, seconds: float) -> None:
        self.until = max(self.until, time.monotonic() + seconds)

    async def passed(self, sleep) -> None:
        waited = None
        # Once for each wait that somebody asked for; one that grows meanwhile is waited for too.
        while (until := self.until) > time.monotonic() and until != waited:
            waited = until
            await _slept(sleep, until - time.monotonic())


async def _called(call, request, retry: Retry, gate: _Gate, sleep, threads: Executor):
    """One request: repeated after errors that pass; the last error is raised. A plain function runs in a thread."""
    for attempt in range(retry.tries):
        wait = 0.0
        async with gate.slots:
            await gate.passed(sleep)
            try:
                if inspect.iscoroutinefunction(call):
                    return await call(request)
                return await asyncio.get_running_loop().run_in_executor(threads, call, request)
            except CallError as e:
                wait = backoff_seconds(attempt, e.status, e.retry_after, retry.base, retry.most)
                if wait is None or attempt == retry.tries - 1:
                    raise
                if e.status == 429:
                    gate.hold(wait)
                    wait = 0.0
        # A wait of the request's own leaves its place to others.
        if wait:
            await _slept(sleep, wait)
    raise CallError(None)


def answered(requests: DataFrame, column: str, make_call: Callable[[], Callable], concurrency: int = 20, retry: Retry = Retry(), sleep=asyncio.sleep, in_flight: int = 1) -> DataFrame:  # noqa: B008
    """requests with answer and error, a row's failure is its error. In each of `concurrency` tasks make_call() opens a connector, a plain or an async function.

    A task has at most `in_flight` calls under way, all tasks together concurrency * in_flight; its rows come out in the order
    in which they went in. A 429 makes all calls of its task wait. sleep may be plain or async.
    """
    fields = requests.schema.names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make_call()

        async def one(request, gate, threads):
            try:
                return await _called(call, request, retry, gate, sleep, threads), None
            except Exception as e:  # noqa: BLE001 - becomes data
                return None, str(e) or type(e).__name__

        async def batch(values, gate, threads):
            # As many workers as calls may be under way: a batch makes no task for every row.
            out, todo = [None] * len(values), iter(range(len(values)))

            async def work():
                for i in todo:
                    out[i] = await one(values[i], gate, threads)

            await asyncio.gather(*(work() for _ in range(in_flight)))
            return out

        with asyncio.Runner() as runner, ThreadPoolExecutor(in_flight) as threads:
            gate = _Gate(in_flight)
            for frame in frames:
                found = runner.run(batch(list(frame[column]), gate, threads))
                yield frame[fields].assign(answer=[a for a, _ in found], error=[e for _, e in found])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema)
    return requests.repartition(concurrency).mapInPandas(run, f"{kinds}, answer string, error string")


def model_outputs(tasks: DataFrame, prompt: str, models: dict[str, Callable[[], Callable] | None], **kw) -> DataFrame:
    """(tasks, model, output): a row for each task and model. A model is a connector, None where there is none; a failed call is named in its output."""
    from quarrymill.operators.evaluate import NO_MODEL

    out = []
    for name, make_call in models.items():
        if make_call is None:
            out.append(tasks.withColumns({"model": F.lit(name), "output": F.lit(NO_MODEL)}))
            continue
        found = answered(tasks, prompt, make_call, **kw)
        said = F.coalesce("answer", F.concat(F.lit("[Error: "), "error", F.lit("]")))
        out.append(found.select(*tasks.columns, F.lit(name).alias("model"), said.alias("output")))
    return reduce(DataFrame.unionByName, out)


def judged_outputs(outputs: DataFrame, models: list[str], template: str, make_call: Callable[[], Callable], id_col: str = "sample_id", **kw) -> DataFrame:
    """(id, evaluation JSON or null, error, raw) of each sample none of whose outputs is missing: a judge's answer to template with {output_a}, {output_b}, ... filled in order of models."""
    from quarrymill.functions import jsonx as J
    from quarrymill.functions.scan import filled
    from quarrymill.operators.evaluate import judgeable

    rows = judgeable(outputs, models, id_col)
    asked = rows.select(id_col, filled(template, **{f"output_{'abcdefgh'[i]}": F.col(f"output_{m}") for i, m in enumerate(models)}).alias("__q"))
    found = answered(asked, "__q", make_call, **kw)
    evaluation, error, raw = J.judged(F.col("answer"))
    failed = F.col("answer").isNull()
    return found.select(id_col, evaluation.alias("evaluation"), F.when(failed, F.col("error")).otherwise(error).alias("error"), F.when(~failed, raw).alias("raw"))


def parsed_documents(files: DataFrame, parsers: dict[str, Callable[[bytes], list[str]]], prefer: tuple[str, ...]) -> DataFrame:
    """(path, page, text, error) of files(path, content): the first parser of `prefer` that there is; a row a page."""
    name = next((p for p in prefer if p in parsers), None)
    if name is None:
        raise ValueError(f"none of {prefer} is available")
    parse = parsers[name]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out += [(path, i, text, None) for i, text in enumerate(parse(bytes(content)))]
                except Exception as e:  # noqa: BLE001 - becomes data
                    out.append((path, None, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "page", "text", "error"]).astype({"page": "Int64"})

    return files.select("path", "content").mapInPandas(run, "path string, page long, text string, error string")


def extracted_figures(files: DataFrame, extract: Callable[[bytes], list[tuple[int, int, int, bytes]]]) -> DataFrame:
    """(path, page, idx, width, height, image) of files(path, content): extract gives (page, width, height, image) of each picture, in order.

    A file that fails has no pictures. Sizes are filtered and figures numbered by figures.numbered_figures.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    out += [(path, page, i, w, h, image) for i, (page, w, h, image) in enumerate(extract(bytes(content)))]
                except Exception:  # noqa: BLE001, S112 - no pictures of this file
                    continue
            yield pd.DataFrame(out, columns=["path", "page", "idx", "width", "height", "image"])

    return files.select("path", "content").mapInPandas(run, "path string, page long, idx long, width long, height long, image binary")


def compared_figures(pairs: DataFrame, question: str, make_call: Callable[[], Callable[[str], str]], **kw) -> DataFrame:
    """pairs with a model's verdict, confidence, reasoning and the level that follows; a failed call is uncertain (null level) with its error."""
    from quarrymill.functions import jsonx as J
    from quarrymill.operators.tables import model_verdict

    found = answered(pairs, question, make_call, **kw)
    verdict, confidence, reasoning = J.verdict(F.col("answer"))
    said = found.withColumns({"verdict": verdict, "confidence": confidence, "reasoning": reasoning})
    said = said.withColumns({c: F.when(F.col("answer").isNotNull(), F.col(c)) for c in ("verdict", "confidence", "reasoning")})
    return said.withColumn("level", model_verdict(F.col("verdict"), F.col("confidence"))).drop("answer")


def described_posters(requests: DataFrame, column: str, make_call: Callable[[], Callable[[str], str]], **kw) -> DataFrame:
    """requests with content, layout and error: a model's answer in two parts. A failed call has neither."""
    from quarrymill.functions import jsonx as J

    found = answered(requests, column, make_call, **kw)
    content, layout = J.split_response(F.col("answer"))
    return found.withColumns({"content": content, "layout": F.when(F.col("answer").isNotNull(), layout)}).drop("answer")


def read_elements(elements: DataFrame, label: str, make_read: Callable[[str], Callable[[list[bytes]], list[str]]], batch: int = 8) -> DataFrame:
    """elements(label, crop, ...) with text: those of one label go together to make_read(label), in batches."""
    fields = [f for f in elements.schema.names if f != "crop"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers: dict = {}
        for frame in frames:
            for kind, own in frame.groupby(label, sort=False, dropna=False):
                read = readers.setdefault(kind, make_read(kind))
                crops = [bytes(c) for c in own["crop"]]
                texts = [t.strip() for lo in range(0, len(crops), batch) for t in read(crops[lo : lo + batch])]
                yield own[fields].assign(text=texts)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in elements.schema if f.name != "crop")
    # A label may hold most rows: it is spread by a salt.
    return elements.repartition(F.col(label), F.pmod(F.monotonically_increasing_id(), F.lit(16))).mapInPandas(run, f"{kinds}, text string")


def extracted_sections(papers: DataFrame, text: str, make_call: Callable[[], Callable[[str], str]], fallback: dict, most: int = 15_000, **kw) -> DataFrame:
    """papers with each section of `fallback` (name -> column by patterns) and method: by a model from the first 15,000 characters, else by patterns."""
    from quarrymill.functions import jsonx as J

    asked = papers.withColumn("__q", F.left(text, F.lit(most)))
    found = answered(asked, "__q", make_call, **kw).withColumn("__j", J.leading_fence(J.stripped(F.col("answer"))))
    by_model = F.col("__j").isNotNull()
    sections = [F.when(by_model, F.coalesce(J.field(F.col("__j"), f"$.{name}"), F.lit(""))).otherwise(c).alias(name) for name, c in fallback.items()]
    return found.select(*papers.columns, *sections, F.when(by_model, "llm").otherwise("llm_fallback_regex").alias("method"))
