"""Provider calls: one client per partition, retries with backoff, dry runs, and a bounded repair loop.

The client factory, the sleep and the clock are passed in. Calls have side effects, so their results are written before
anything reads them: a recomputed lineage must not call twice.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import partition_stage
from ..session import written

RETRYABLE = frozenset({429, 500, 502, 503, 504})
ATTEMPTS, FIRST_WAIT = 3, 2.0
RESULT = "outcome string, attempts int, error_code int, text string, finish_reason string"


class CallError(Exception):
    def __init__(self, code: int | None, message: str = "") -> None:
        super().__init__(message)
        self.code = code


def call(client: Callable[[dict], dict], request: dict, sleep: Callable[[float], None] = time.sleep, attempts: int = ATTEMPTS) -> tuple:
    """(outcome, attempts, error code, text, finish reason); waits of 2, 4, 8 ... seconds between attempts."""
    wait = FIRST_WAIT
    for n in range(1, attempts + 1):
        try:
            r = client(request)
            return "success", n, None, r.get("text"), r.get("finish_reason")
        except CallError as e:
            if e.code not in RETRYABLE or n == attempts:
                return "failed", n, e.code, None, None
        except (ConnectionError, TimeoutError):
            if n == attempts:
                return "failed", n, None, None, None
        sleep(wait)
        wait *= 2
    return "failed", 0, None, None, None


def call_chain(clients: list[Callable[[dict], dict]], request: dict, accepted: Callable[[str | None], bool], sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(client number, *result of call) of the first of several clients (primary, repair, fallback) whose answer is
    accepted; each is told the answer before it. None accepted: the last result, with the number -1."""
    result: tuple = ("failed", 0, None, None, None)
    for k, client in enumerate(clients):
        result = call(client, request | {"previous": result[3]}, sleep)
        if result[0] == "success" and accepted(result[3]):
            return (k, *result)
    return (-1, *result)


def run_calls(requests: DataFrame, keys: list[str], prompt: str, client_factory: Callable[[], Callable[[dict], dict]], sleep=time.sleep, dry_run: bool = False, ledger: DataFrame | None = None) -> DataFrame:
    """The keys with the result of each request, written once. A dry run makes no client and no call.

    Requests whose keys are in the ledger (results of earlier runs) are not made again. Each request carries request_key,
    a hash of its keys and prompt, by which a client that a retried task asks again can give its first answer."""
    if ledger is not None:
        requests = requests.join(ledger.where("outcome = 'success'").select(*keys).distinct(), keys, "left_anti")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.select(*keys).schema) + ", " + RESULT
    if dry_run:
        none = lambda t: F.lit(None).cast(t)
        return requests.select(*keys, F.lit("planned").alias("outcome"), F.lit(0).alias("attempts"), none("int").alias("error_code"), none("string").alias("text"), none("string").alias("finish_reason"))

    def go(feed):
        client = None
        for batch in feed:
            client = client or client_factory()
            for i, p in enumerate(batch["_prompt"]):
                row = tuple(batch[k][i] for k in keys)
                sent = hashlib.sha256(repr((row, p)).encode("utf-8", "surrogatepass")).hexdigest()
                yield (*row, *call(client, dict(zip(keys, row)) | {"prompt": p, "request_key": sent}, sleep))

    return written(partition_stage(requests.select(*keys, F.col(prompt).alias("_prompt")), schema, go), "calls")


def repair_rounds(state: DataFrame, pending: Callable[[DataFrame], DataFrame], one_round: Callable[[DataFrame, DataFrame, int], DataFrame], rounds: int = 2) -> tuple[DataFrame, int]:
    """(state, rounds run): at most `rounds`, none once nothing is pending. Every round's state is written, which cuts
    its lineage and keeps its calls from being made again."""
    done = 0
    for k in range(1, rounds + 1):
        todo = pending(state)
        if todo.isEmpty():
            break
        state = written(one_round(state, todo, k), f"round{k}")
        done = k
    return state, done
