"""Secret scans: fixed patterns, and character Markov models by log-likelihood ratio.

The patterns label the samples: the values they find anywhere in the corpus are the random
strings, all other text of the identifier alphabet is ordinary, and so are the names of
``ordinary_identifiers`` (code, dates, versions, hosts, paths), which prose does not teach.
First-order character models are counted from them, those of the corpus over the whole of it; a
token of SHORTEST characters or more that no pattern covers is a secret when the ratio of its
likelihoods is high enough, in all and a character.
"""

from __future__ import annotations

import builtins
import encodings.aliases
import functools
import html.entities
import http.client
import logging
import mimetypes
import os
import re
import socket
import unittest
import xml.dom.minidom
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import slices, text_or_empty
from shelfcast.llm.spans import utf8

# fixed patterns of the base rules
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run either has 24 characters or fails
KINDS = ["assign", "access", "hex", "markov"]

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LONG = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
SHORTEST = 10  # characters of the tokens that the models score
SCORED = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
SIZE = len(ALPHABET) + 1
CODE = np.zeros(256, np.int64)  # 0: any other byte, a token's border
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SIZE)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_SCORE, MIN_PER_CHAR = 10.5, 0.8  # natural logs: odds of 36,000 to 1 in all

SHAPES = ("2023-11-05T08:15:00", "1999-12-31", "20-06-2018", "v1.12.0-rc2", "3.10.4", "0.9.1-beta.3", "10.0.0.1", "192.168.1.254",
          "www.example.org/index.html", "docs.example.net/guide/intro.html", "mail.example.com", "src/main/java/App.java",
          "lib/utils/string_helpers.py", "/usr/local/bin/python3.11", "/etc/nginx/nginx.conf", "report_2021-03.csv",
          "data/raw/part-00000.parquet", "README.md", "ISO-8859-15", "RFC-2616", "X.509", "IEEE-754", "UTF-16LE", "A4/A5",
          "555-0142", "+44-20-7946-0958", "1e-06", "3.14159", "100/200", "2019/2020", "Q3-2022", "COVID-19", "and/or",
          "state-of-the-art", "e-mail", "C++/Java", "TCP/IP", "Windows-1252", "node_modules/react/index.js", "main.cpp")
CLASS = np.array([0] + [1] * 26 + [2] * 26 + [3] * 10 + [4] * 6)  # of a code: border, upper, lower, digit, mark
FOLD = np.array([0, *range(1, 27), *range(1, 27), *[27] * 10, *range(28, 34)])  # a code without its case; all digits are one

Span = tuple[int, int, str]


@functools.cache
def ordinary_identifiers() -> tuple[str, ...]:
    """Labelled ordinary samples: names of the standard library and of HTML's characters, media types,
    encodings, and SHAPES for what is no name (dates, versions, hosts, paths)."""
    modules = (builtins, http.client, logging, os, re, socket, unittest, unittest.TestCase, xml.dom.minidom, xml.dom.minidom.Document)
    names = {n.strip("_") for m in modules for n in dir(m)} | {n.rstrip(";") for n in html.entities.html5 if len(n) > 10}
    names |= set(mimetypes.MimeTypes(()).types_map[True].values())  # the built-in table, not the machine's
    names |= set(encodings.aliases.aliases)
    return (*sorted(names - {""}), *SHAPES * 20)


def identifier_model(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities (previous, next) of ordinary identifiers: how classes of characters follow each
    other in the samples, times how characters do whatever their case, in the samples and in the
    corpus' ordinary ``counts`` alike; digits are equally likely."""
    c = counts.reshape(SIZE, SIZE).astype(float)
    c[:, 0] = 0
    own = pairs("\n".join(ordinary_identifiers()).encode()).reshape(SIZE, SIZE).astype(float)
    shape = np.zeros((5, 5))
    np.add.at(shape, (CLASS[:, None], CLASS[None, :]), own)
    shape = (shape + 0.5) / (shape + 0.5)[:, 1:].sum(1, keepdims=True)
    wide = int(FOLD.max()) + 1
    both = np.zeros((wide, wide))
    for table in (own, c):
        n = np.zeros((wide, wide))
        np.add.at(n, (FOLD[:, None], FOLD[None, :]), table)
        one = (n.sum(0) + 1) / (n.sum() + wide)
        both += 0.5 * (n + 5 * one) / (n.sum(1, keepdims=True) + 5)
    # given the class of the next character
    p = both[FOLD[:, None], FOLD[None, :]]
    kind = np.zeros((SIZE, 5))
    np.add.at(kind, (np.arange(SIZE)[:, None], CLASS[None, :]), p)
    return np.log(shape[CLASS[:, None], CLASS[None, :]] * p / kind[np.arange(SIZE)[:, None], CLASS[None, :]])[:, 1:]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost without overlap within a kind; code points."""
    out: list[Span] = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for m in LONG.finditer(text):  # holds every access key of 20 and every hex run of 24
        s, t = m.start(), m[0]
        if "AKIA" in t:
            out += [(s + x.start(), s + x.end(), "access") for x in ACCESS.finditer(t) if len(x[0]) >= 20]
        out += [(s + x.start(), s + x.end(), "hex") for x in HEX.finditer(t)]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def pairs(data: bytes | np.ndarray) -> np.ndarray:
    """Counts of (previous, next) codes with next in the alphabet; flat."""
    c = CODE[np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data]
    p = np.concatenate([[0], c[:-1]]) * SIZE + c
    return np.bincount(p[c > 0], minlength=SIZE * SIZE)


class MarkovRatio:
    """Log-likelihood ratio (random over ordinary) of each character given the one before."""

    def __init__(self, random: np.ndarray, ordinary: np.ndarray):
        def model(counts: np.ndarray) -> np.ndarray:
            n = counts.reshape(SIZE, SIZE)[:, 1:].astype(float)
            # an unseen character gets the weight of one observation spread by a uniform law
            return np.log((n + 1 / (SIZE - 1)) / (n.sum(1, keepdims=True) + 1))

        uniform = np.full((SIZE, SIZE - 1), -np.log(SIZE - 1))
        seen = model(random)
        # random strings outside the samples may use the whole alphabet
        mixed = np.logaddexp(seen + np.log(0.5), uniform + np.log(0.5))
        # an ordinary token may be prose or an identifier
        plain = np.logaddexp(model(ordinary) + np.log(0.5), identifier_model(ordinary) + np.log(0.5))
        self.ratio = np.hstack([np.zeros((SIZE, 1)), mixed - plain])

    def score(self, token: str) -> float:
        c = CODE[np.frombuffer(token.encode(), np.uint8)]
        return float(self.ratio[np.concatenate([[0], c[:-1]]), c].sum())

    def spans(self, text: str, base: list[Span]) -> list[Span]:
        out, i = [], 0
        cover = sorted((s, e) for s, e, _ in base)
        for m in SCORED.finditer(text):
            s, e = m.span()
            while i < len(cover) and cover[i][1] <= s:
                i += 1
            if any(a < e and b > s for a, b in cover[i:i + 3]):
                continue
            t = m[0].strip(".=-_/+")
            if len(t) < SHORTEST:
                continue
            score = self.score(t)
            if score >= MIN_SCORE and score >= MIN_PER_CHAR * len(t):
                s += m[0].index(t)
                out.append((s, s + len(t), "markov"))
        return out


def train(docs: DataFrame, text: str = "text") -> MarkovRatio:
    """Count both models over every whole text.  Each task adds up its own table, so at most
    one row per cell and task is shuffled; the driver gets one row per cell."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everything = np.zeros(SIZE * SIZE, np.int64)
        random = np.zeros(SIZE * SIZE, np.int64)
        covered = np.zeros(SIZE * SIZE, np.int64)
        for b in slices(batches):
            everything += pairs(utf8(b.column(0))[0])
            for t in b.column(0).to_pylist():
                for s, e, kind in base_spans(t):
                    value = t[s:e].encode()
                    covered += pairs(value)
                    if kind == "assign":
                        value = ASSIGN.match(t, s)[2].encode()
                    random += pairs(value)
        ordinary = np.maximum(everything - covered, 0)
        cell = np.flatnonzero(random + ordinary)
        yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(random[cell]), pa.array(ordinary[cell])],
                              ["cell", "random", "ordinary"])

    rows = (docs.select(text_or_empty(text).alias("text"))
            .mapInArrow(count, "cell int, random long, ordinary long")
            .groupBy("cell").agg(F.sum("random"), F.sum("ordinary")).collect())
    random, ordinary = np.zeros(SIZE * SIZE, np.int64), np.zeros(SIZE * SIZE, np.int64)
    for cell, r, o in rows:
        random[cell], ordinary[cell] = r, o
    return MarkovRatio(random, ordinary)


def find(text: str, model: MarkovRatio) -> list[Span]:
    base = base_spans(text)
    return in_order(base + model.spans(text, base))


def scan(docs: DataFrame, model: MarkovRatio, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` (kind, start, end in code points; by start, then kind) of every
    whole text; null and empty texts have none, repeated rows are scanned each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in find(t, model)]
                     for t in b.column(1).to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([b.column(0), pa.array(found, kind)], ["key", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("key"), text_or_empty(text).alias("text"))
    return (rows.mapInArrow(run, "key long, spans array<struct<kind:string,start:long,end:long>>")
            .withColumnRenamed("key", key))


def redact(docs: DataFrame, model: MarkovRatio, text: str = "text", mark: str = "[SECRET]",
           length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by one) and
    ``length`` set to the new number of code points where a text changed.  No row is dropped;
    null texts and all other columns stay."""
    def clean(t: str | None) -> str | None:
        spans = find(t, model) if t else []
        if not spans:
            return t
        out, at = [], 0
        for s, e, _ in spans:
            if s >= at:
                out += [t[at:s], mark]
            at = max(at, e)
        return "".join([*out, t[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            at = b.schema.get_field_index(text)
            old = b.column(at).to_pylist()
            new = [clean(t) for t in old]
            b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            if length is not None and length in b.schema.names:
                at = b.schema.get_field_index(length)
                n = [len(x) if x != y else z for x, y, z in zip(new, old, b.column(at).to_pylist())]
                b = b.set_column(at, b.schema.field(at), pa.array(n, b.schema.field(at).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
