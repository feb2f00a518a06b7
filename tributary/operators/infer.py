"""The model call: one per row, by a client that each partition makes for itself."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.operators.materialize import materialize


class Client(Protocol):
    def chat(self, prompt: str) -> Any: ...


#: A picklable callable; called once for each partition that has rows.
ClientFactory = Callable[[], Client]

RESPONSE = ("response", "error_class", "error_text")


def within(seconds: float | None, client: Client, prompt: str | None) -> Any:
    """The client's reply, or a TimeoutError after so many seconds; a call that hangs is left to a thread of its own."""
    if seconds is None:
        return client.chat(prompt)
    got: list[Any] = []

    def run() -> None:
        try:
            got.append((client.chat(prompt), None))
        except Exception as error:
            got.append((None, error))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if not got:
        raise TimeoutError(f"no reply within {seconds:g} s")
    reply, error = got[0]
    if error is not None:
        raise error
    return reply


def call(client: Client, prompt: str | None, timeout: float | None = None, retries: int = 0) -> tuple[str | None, str | None, str | None]:
    """``(response, error_class, error_text)``; an Exception of the client or a reply that is no string is an error.

    An Exception is tried again up to ``retries`` times; what counts is the last try. A reply is never tried again.
    """
    for left in range(retries, -1, -1):
        try:
            reply = within(timeout, client, prompt)
            break
        except Exception as error:
            if not left:
                return None, type(error).__name__, str(error)
    try:
        if not isinstance(reply, str):
            reply.strip().startswith("```")  # raises what a caller that expects a string would meet
            raise TypeError(f"the client returned {type(reply).__name__}")
        return reply.encode("utf-8", "replace").decode("utf-8"), None, None
    except Exception as error:
        return None, type(error).__name__, str(error)


def infer(
    df: DataFrame,
    factory: ClientFactory,
    *,
    key: str = "feedback_id",
    prompt: str = "prompt",
    path: str | None = None,
    save: bool = True,
    per_second: float | None = None,
    timeout: float | None = None,
    retries: int = 0,
) -> DataFrame:
    """``(key, response, error_class, error_text)``, one row per input row.

    The key may be of any type; its Arrow array goes through untouched, nulls included. A row whose call fails keeps
    the others unharmed. ``save`` writes the table before anything reads it: a plan over ``mapInArrow`` that is run
    by two actions would call twice. Task retries may still repeat calls; keep ``spark.speculation`` off. Extensions:
    ``per_second`` holds each partition to that many calls a second, ``timeout`` ends a call that hangs, so that it
    holds up one row and not its partition, and ``retries`` repeats calls that raise. Null prompts are passed on as
    they are. Empty input: empty output, no client.
    """
    rows = df.select(F.col(key).alias("key"), F.col(prompt).alias("prompt"))
    schema = StructType([rows.schema["key"]])
    for name in RESPONSE:
        schema = schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client, free = None, time.monotonic()
        for batch in batches:
            if client is None and batch.num_rows:
                client = factory()
            got = []
            for x in batch.column(1):
                if per_second:
                    time.sleep(max(0.0, free - time.monotonic()))
                    free = max(free, time.monotonic()) + 1 / per_second
                got.append(call(client, x.as_py(), timeout, retries))
            made = [pa.array([x[i] for x in got], pa.string()) for i in range(len(RESPONSE))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], schema.fieldNames())

    called = rows.mapInArrow(run, schema)
    if save or path:
        called = materialize(called, path)
    return called.withColumnRenamed("key", key)
