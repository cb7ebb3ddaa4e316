"""Partitions put questions to owners of a key range and get one answer for each question.

The rows of a partition never move. Only packed questions travel to the owners and only packed
answers travel back, so the traffic is that of the keys and not that of the texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark import RDD

Ask = Callable[[Iterator[Any]], Iterable[tuple[int, bytes]]]
Answer = Callable[[int, list[bytes]], list[bytes]]
Use = Callable[[int, Iterator[Any], list[tuple[int, bytes, bytes]]], Iterable[Any]]

#: Rows that travel together between Python and Spark.
CHUNK_ROWS = 16


def _same(key: int) -> int:
    return key


def _chunks(rows: Iterator[Any]) -> Iterator[list[Any]]:
    while chunk := list(itertools.islice(rows, CHUNK_ROWS)):
        yield chunk


def exchange(rows: RDD, owners: int, ask: Ask, answer: Answer, use: Use) -> RDD:
    """Ask, answer and use.

    ``ask(rows)`` yields ``(owner, question)`` for one partition that has rows: at least one, and at most one
    for each owner. ``answer(owner, questions)`` gives the answers in the same order. ``use(partition,
    rows, answers)`` gets the partition's rows again, as a stream, with ``(owner, question, answer)``
    of all its questions, and yields results.

    ``rows`` is computed twice and must have the same rows in the same partitions each time, as a scan
    of files does; another number of them fails the job. Everything is plain lineage: a lost executor costs the recomputation
    of its partitions.
    """
    parts = rows.getNumPartitions()

    def asked(part: int, it: Iterator[Any]) -> Iterator[tuple[int, tuple[int, bytes]]]:
        seen = 0

        def counted() -> Iterator[Any]:
            nonlocal seen
            for row in it:
                seen += 1
                yield row

        questions = list(ask(counted()))
        for owner, question in questions:
            yield owner, (part, -(-seen // CHUNK_ROWS), question)

    def answered(it: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, tuple]]:
        held: dict[int, list[tuple]] = {}
        for owner, asked_by in it:
            held.setdefault(owner, []).append(asked_by)
        for owner, asked_by in held.items():
            replies = answer(owner, [question for _, _, question in asked_by])
            for (part, chunks, question), reply in zip(asked_by, replies, strict=True):
                yield part, (chunks, (owner, question, reply))

    def delivered(it: Iterator[tuple[int, tuple]]) -> Iterator[list | None]:
        """All answers with the first chunk of rows, nothing with the others."""
        got = [reply for _, reply in it]
        if got:
            yield [reply for _, reply in got]
            yield from itertools.repeat(None, got[0][0] - 1)

    replies = (
        rows.mapPartitionsWithIndex(asked)
        .partitionBy(max(1, owners), _same)
        .mapPartitions(answered)
        .partitionBy(max(1, parts), _same)
        .mapPartitions(delivered)
    )
    # A deployment may deal keys to more partitions than asked for; the rows get empty ones to match.
    more = replies.getNumPartitions() - parts
    if more > 0:
        rows = rows.union(rows.context.parallelize([], more))

    def used(part: int, it: Iterator[tuple[list, list | None]]) -> Iterator[Any]:
        for chunk, answers in it:
            rest = (row for more, _ in it for row in more)
            yield from use(part, itertools.chain(chunk, rest), answers)

    return rows.mapPartitions(_chunks).zip(replies).mapPartitionsWithIndex(used)
