"""Places where a reader of files, a detector of names, a model for vectors or an extractor is plugged in.

Each provider is a plain function that is called on the executors, on batches, and loaded once in each task. The engine
gives deterministic ones: the gazetteer and the hashed vectors of ``graph``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, size and content of files, the content being read only where it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.col("length").alias("size"), "content")


def file_digests(files: DataFrame) -> DataFrame:
    """path, size and sha256 of each file's bytes."""
    return files.select("path", "size", F.sha2("content", 256).alias("sha256"))


def file_pages(files: DataFrame, pages_of: Callable[[bytes], list[str]]) -> DataFrame:
    """doc_id (the sha256), page_no from 1, text, char_count of files (content), by a reader of their format.

    A file that the reader refuses (ValueError) gives no pages.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, content in zip(pdf["doc_id"], pdf["content"]):
                try:
                    out += [(doc, i, t, len(t)) for i, t in enumerate(pages_of(bytes(content)), 1)]
                except ValueError:
                    continue
            yield pd.DataFrame(out, columns=["doc_id", "page_no", "text", "char_count"])

    return files.select(F.sha2("content", 256).alias("doc_id"), "content").mapInPandas(run, "doc_id string, page_no int, text string, char_count int")


def detected(chunks: DataFrame, detect: Callable[[str], list[tuple[str, str]]]) -> DataFrame:
    """chunk_id, pos, surface, entity_type of a detector's finds, each (surface, type) once per passage, in the order found."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(c, i, s, k) for c, t in zip(pdf["chunk_id"], pdf["text"]) for i, (s, k) in enumerate(dict.fromkeys(detect(t or "")))]
            yield pd.DataFrame(out, columns=["chunk_id", "pos", "surface", "entity_type"])

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id string, pos int, surface string, entity_type string")


def embedded(rows: DataFrame, key: str, load: Callable[[], Callable[[list[str]], list[list[float]]]], prefix: str = "") -> DataFrame:
    """key and embedding: ``load`` gives the model once in each task; ``prefix`` goes before each text, as queries have one and passages none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "embedding": model([prefix + (t or "") for t in pdf["text"]])})

    return rows.select(key, "text").mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, embedding array<float>")


def extracted(prompts: DataFrame, complete: Callable[[str], str], fields: list[str]) -> DataFrame:
    """chunk_id, status (extracted or dead_letter), attempts, answer, error: an answer must be a JSON object with the fields and no others.

    An answer that is not gets one more try, with what was wrong; a second failure, or a refusal (PermissionError), is a
    dead letter with the last answer.
    """

    def fault(text: str) -> str:
        try:
            data = json.loads(text)
        except json.JSONDecodeError as e:
            return f"no JSON: {e.msg}"
        if not isinstance(data, dict) or set(data) != set(fields):
            return "other fields than " + ", ".join(fields)
        return ""

    def one(prompt: str) -> tuple[str, int, str, str]:
        text, wrong, ask = "", "", prompt
        for attempt in (1, 2):
            try:
                text = complete(ask)
            except PermissionError as e:
                return "dead_letter", attempt, "", f"refusal: {e}"
            wrong = fault(text)
            if not wrong:
                return "extracted", attempt, text, ""
            ask = f"{prompt}\n\nThe answer was not valid ({wrong}):\n{text[:2000]}"
        return "dead_letter", 2, text, wrong

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(c, *one(p or "")) for c, p in zip(pdf["chunk_id"], pdf["prompt"])], columns=["chunk_id", "status", "attempts", "answer", "error"])

    return prompts.select("chunk_id", "prompt").mapInPandas(run, "chunk_id string, status string, attempts int, answer string, error string")
