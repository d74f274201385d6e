"""Secret scan: one combined deterministic automaton for all rules, one pass over a text's bytes.

Every rule runs in the same minimised automaton, which begins anew at every byte; where a rule's
accepting state is left, a match ends, and a small reversed automaton of that rule walks back
to the leftmost begin after the rule's previous match.  Matches are thus leftmost, as long as possible
and non-overlapping per rule; then those below the rule's least length are dropped.

Spans are in code points, end exclusive.  Defined results: null or empty text has no spans; repeated
rows are scanned one by one; null ids are kept; an empty table gives no rows; other columns pass
through ``redact`` untouched and are ignored by ``scan``.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from .automaton import compile_rules, parse
from .text import tidy


@dataclass(frozen=True)
class Rule:
    """``head`` + ``tail`` is the pattern; ``least`` bytes are asked of the tail (what follows the longest head)."""

    kind: str
    head: str
    tail: str
    least: int
    any_case: bool = False
    base: bool = False


#: Fixed patterns of the base kinds, then further public key formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]+", 6, True, True),
    Rule("access", "AKIA", "[A-Z0-9]+", 16, base=True),
    Rule("hex", "", "[0-9a-f]{24,}", 24, base=True),
    Rule("code_host", "gh[opsu]_", "[A-Za-z0-9]+", 36),
    Rule("chat", "xox[abprs]-", "[A-Za-z0-9-]+", 10),
    Rule("payment", "sk_live_", "[A-Za-z0-9]+", 16),
    Rule("private_key", "-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY", "-----", 5),
)


class Scanner:
    """Compiled rules: built once on the driver, sent with the task; rows of a table become lists on first use."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        whole = [("seq", [parse(r.head, r.any_case), parse(r.tail, r.any_case)]) for r in rules]
        both = compile_rules(whole, anywhere=True)
        self.rules, self.table, self.next, self.accepts, self.hot = rules, both, None, both.accepts.tolist(), both.first_accept
        self.back = [self._plain(compile_rules([tree], anywhere=False, reverse=True)) for tree in whole]
        self.heads = [self._plain(compile_rules([parse(r.head, r.any_case)], anywhere=False)) if r.head else None for r in rules]

    @staticmethod
    def _plain(a) -> tuple:
        rows = a.rows()
        dead = [s < a.first_accept and set(row) == {s} for s, row in enumerate(rows)]
        return rows, a.first_accept, dead

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(end, rule) of every point where a rule's accepting states are left, from one pass over the bytes."""
        if self.next is None:
            self.next = self.table.rows()
        rows, accepts, hot, found = self.next, self.accepts, self.hot, []
        s = held = 0
        for i, c in enumerate(data):
            s = rows[s][c]
            if s >= hot or held:
                now = accepts[s]
                gone = held & ~now
                if gone:
                    found += [(i, k) for k in range(len(self.rules)) if gone >> k & 1]
                held = now
        return found + [(len(data), k) for k in range(len(self.rules)) if held >> k & 1]

    def begin(self, k: int, data: bytes, end: int, least: int) -> int:
        """Leftmost begin, not before ``least``, of a match of rule k that ends at ``end``; -1 if none."""
        rows, hot, dead = self.back[k]
        s, best = 0, -1
        for i in range(end - 1, least - 1, -1):
            s = rows[s][data[i]]
            if s >= hot:
                best = i
            elif dead[s]:
                break
        return best

    def tail(self, k: int, data: bytes, start: int, end: int) -> int:
        """Bytes after the longest head of rule k from ``start``."""
        if self.heads[k] is None:
            return end - start
        rows, hot, dead = self.heads[k]
        s, cut = 0, start
        for i in range(start, end):
            s = rows[s][data[i]]
            if s >= hot:
                cut = i + 1
            elif dead[s]:
                break
        return end - cut

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, by start, then rule."""
        done, out = [0] * len(self.rules), []
        for end, k in self.ends(data):
            start = self.begin(k, data, end, done[k])
            if start >= 0:
                done[k] = end
                if self.tail(k, data, start, end) >= self.rules[k].least:
                    out.append((start, end, k))
        return sorted(out, key=lambda x: (x[0], x[2]))


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as code point spans; the text is decoded once, piece by piece."""
    points = sorted({p for s in spans for p in s[:2]})
    at, n, where = 0, 0, {}
    for p in points:
        n += len(data[at:p].decode("utf-8", "surrogatepass"))
        at, where[p] = p, n
    return [(where[s], where[e], k) for s, e, k in spans]


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text and spans: array of (kind, start, end, base), sorted by start, then rule order."""

    scanner = Scanner(rules)

    def scan(batches):
        for batch in batches:
            found = []
            for value in batch.column(1):
                data = value.as_py()
                data = b"" if data is None else data.encode("utf-8", "surrogatepass")
                found.append([{"kind": rules[k].kind, "start": s, "end": e, "base": rules[k].base}
                              for s, e, k in code_points(data, scanner.spans(data))])
            kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(kind))], [*batch.schema.names, "spans"])

    schema = ST.StructType([*docs.schema.fields, ST.StructField("spans", ST.ArrayType(ST.StructType([
        ST.StructField("kind", ST.StringType()), ST.StructField("start", ST.LongType()),
        ST.StructField("end", ST.LongType()), ST.StructField("base", ST.BooleanType())])))])
    return docs.mapInArrow(tidy(scan), schema)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans of every row."""
    return with_spans(docs.select("doc_id", "text"), rules).select("doc_id", "spans")


def joined(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The checked columns of ``scan``: counts per base kind, a hash of the base spans and all spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """The table with every found span of ``text`` replaced by ``mask`` (touching spans by one); null stays null."""
    order = docs.columns

    scanner = Scanner(rules)

    def cover(batches):
        for batch in batches:
            texts = []
            for value in batch.column(0):
                data = value.as_py()
                if data is not None:
                    data = data.encode("utf-8", "surrogatepass")
                    out, at = [], 0
                    for s, e, _ in scanner.spans(data):
                        if s > at or not out:
                            out += [data[at:s], mask.encode()]
                        at = max(at, e)
                    data = b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")
                texts.append(data)
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(0).type), *batch.columns[1:]], batch.schema.names)

    first = docs.select("text", *[c for c in order if c != "text"])
    return first.mapInArrow(tidy(cover), first.schema).select(*order)
