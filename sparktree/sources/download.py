"""Fetching files from worker tasks, with the outcome of each as a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "success boolean, file string, status int, error string"


def fetched(files: DataFrame, fetch: Callable[[str, str], int], workers: int = 8) -> DataFrame:
    """fetch(url, filename) -> HTTP status, for each row of files(url, filename), by up to `workers` tasks.

    A row without a url, a status other than 200 and an exception are failures with their reason; none stops the others.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in frames:
            out = []
            for url, name in zip(held["url"], held["filename"]):
                try:
                    status = int(fetch(url, name)) if url else None
                    out.append((status == 200, name, status, None if url else "no url"))
                except Exception as e:  # noqa: BLE001  the reason is the row's result
                    out.append((False, name, None, str(e)))
            yield pd.DataFrame(out, columns=["success", "file", "status", "error"]).astype({"status": "Int32"})

    return files.select("url", "filename").repartition(max(1, workers)).mapInPandas(run, RESULT)


def to_folder(folder: str, get: Callable[[str, float], tuple[int, bytes]], timeout: float = 300.0) -> Callable[[str, str], int]:
    """A fetch function that writes to a folder all workers share: to a temporary name first, so that a failed or
    interrupted transfer never looks like a file that is there."""

    def fetch(url: str, name: str) -> int:
        import os
        import uuid

        status, body = get(url, timeout)
        if status == 200:
            part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
            with open(part, "wb") as f:
                f.write(body)
            os.replace(part, os.path.join(folder, name))
        return status

    return fetch
