"""Secret scans: every rule in one pass over the bytes of each text, by the automaton of all rules."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.llm.automaton import Automaton, Rule
from bedfeed.llm.common import blocks

# The three base rules, then published token formats of well-known services.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 12),
    Rule("access", "AKIA", "[A-Z0-9]", 14),
    Rule("hex", "", "[0-9a-f]", 16),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abeoprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("stripe", "[rs]k_(?:live|test)_", "[A-Za-z0-9]", 16),
    Rule("npm", "npm_", "[A-Za-z0-9]", 36),
    Rule("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY", "[-]", 5),
)
BASE = 3


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


def scanned(automaton: Automaton, data: bytes) -> list[tuple[int, int, int]]:
    """(start, rule, end) of all matches in order, in code points."""
    found = sorted((start, rule, end) for rule, start, end in automaton.scan(data))
    if not found or data.isascii():
        return found
    places, points, last = {}, 0, 0
    for place in sorted({p for start, _, end in found for p in (start, end)}):
        points += len(data[last:place].decode("utf-8", "replace"))
        places[place], last = points, place
    return [(places[start], rule, places[end]) for start, rule, end in found]


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) for every row of documents (doc_id, text, anything else): spans are structs of rule (its place
    in `rules`), start and end in code points, end exclusive, by start, then rule.

    The matches of a rule are leftmost and do not overlap; those with too short a tail are dropped after they were
    matched. Null and empty texts have no spans. Rows that repeat a doc_id or a whole row each give a row.
    """
    kind = dict(docs.dtypes)["doc_id"]
    place = pa.struct([("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])

    automaton = compiled(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches):
            whole = data.tobytes()
            spans = [
                [{"rule": rule, "start": start, "end": end} for start, rule, end in scanned(automaton, whole[offsets[i] : offsets[i + 1]])]
                for i in range(rows.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, pa.list_(place))], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<rule:int,start:long,end:long>>")


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rule"]), s["start"], s["end"])), ",")
