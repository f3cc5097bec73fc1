"""Repair of damaged conversations by dynamic programming over a grammar.

Every row of a conversation becomes a symbol (role initial and fault), a
conversation a sequence of symbols.  Re-Pair replaces frequent pairs by rules,
counted over the distinct sequences of all conversations.  A symbol is a
min-plus matrix over the states of the wanted role order; its entries carry
the cost and, as a rope, the audit (the edits) of the cheapest way.  A rule's matrix is
the product of its two sides, computed once, bottom-up; a conversation is
then a product of a few matrices that all conversations share.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import slices, write_shared

_SPACE = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
_LEGAL = {"su", "ua", "au"}
# states of the wanted order (s?(ua)+)?: nothing yet, after s, after u, after a; the first and last may end it
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDING = (START, ASSISTANT)
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 2, 3, 2, 1
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # where a user or assistant row leads

#: Symbols: role initial s, u, a or o (any other); capitals are truncated rows; - is a row that must go.
ALPHABET = "suaoSUAO-"


# ---- ropes and matrices -------------------------------------------------------------------------

def text_of(rope) -> str:
    """A rope is a string or a pair of ropes."""
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += [r[1], r[0]]
    return "".join(out)


def _least(options: list) -> tuple | None:
    """The cheapest (cost, rope); of equal cost the one whose text is least."""
    if not options:
        return None
    cost = min(c for c, _ in options)
    ties = [r for c, r in options if c == cost]
    return cost, ties[0] if len(ties) == 1 else min(ties, key=text_of)


def _inserts() -> list[list]:
    """The fewest inserted rows that lead from one state to another."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        out[i][i] = (0, "")
        state, rope = i, ""
        for _ in range(2):
            state, rope = _NEXT[state], rope + "I"
            out[i][state] = out[i][state] or (_INSERT * len(rope), rope)
    return out


def product(a: list[list], b: list[list]) -> list[list]:
    """Min-plus product; None is no way.

    Of two ways with equal rows and cost neither audit begins the other (they would differ by paid
    inserts), so taking the least text of each part gives the least text of the whole.
    """
    return [[_least([(a[i][m][0] + b[m][j][0], (a[i][m][1], b[m][j][1])) for m in range(4) if a[i][m] and b[m][j]]) for j in range(4)] for i in range(4)]


def _edits(symbol: str) -> list[list]:
    out: list[list] = [[[] for _ in range(4)] for _ in range(4)]
    extra = _TRUNCATED if symbol.isupper() else 0
    for i in range(4):
        out[i][i].append((_DELETE, "D"))
        if symbol != "-":
            out[i][_NEXT[i]].append((_REROLE + extra, "R"))
            if symbol.lower() == {USER: "u", ASSISTANT: "a"}[_NEXT[i]]:
                out[i][_NEXT[i]].append((_KEEP + extra, "K"))
            if symbol.lower() == "s" and i == START:
                out[i][SYSTEM].append((_KEEP + extra, "K"))
    return [[_least(x) for x in row] for row in out]


class Grammar:
    """Re-Pair rules and a matrix for each symbol; a rule's symbol is its number."""

    def __init__(self, rules: Iterable[tuple] = ()):
        self.rules: dict[tuple, int] = {}
        self.closing = _inserts()
        self.matrix: dict = {c: product(self.closing, _edits(c)) for c in ALPHABET}
        for pair in rules:
            self.add(pair)

    def add(self, pair: tuple) -> None:
        number = len(self.rules)
        self.rules[pair] = number
        self.matrix[number] = product(self.matrix[pair[0]], self.matrix[pair[1]])

    def compress(self, sequence: str) -> list:
        """The sequence with every rule applied, in the order of the rules, from left to right."""
        out = list(sequence)
        have = set(out)
        for (x, y), number in self.rules.items():
            if x not in have or y not in have or len(out) < 2:
                continue
            new, i, n = [], 0, len(out)
            while i < n:
                if i + 1 < n and out[i] == x and out[i + 1] == y:
                    new.append(number)
                    i += 2
                else:
                    new.append(out[i])
                    i += 1
            if len(new) < n:
                out = new
                have = set(out)
        return out

    def whole(self, sequence: str) -> list[list]:
        """The sequence's matrix, as texts."""
        m = self.closing if not sequence else None
        for s in self.compress(sequence):
            m = self.matrix[s] if m is None else product(m, self.matrix[s])
        return [[x and (x[0], text_of(x[1])) for x in row] for row in m]

    def repair(self, sequence: str) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        way = Way()
        for s in self.compress(sequence):
            way.step(self.matrix[s])
        cost, parts = way.end(self.closing)
        return cost, "".join(a for _, a in parts)


class Way:
    """The cheapest ways from the start to each state, step by step; steps hold on to the step before."""

    def __init__(self):
        self.best: list = [(0, None), None, None, None]  # (cost, (step before, state there, rope))

    @staticmethod
    def _before(x, y) -> bool:
        """Whether way x has the lesser text: only what follows their last common step is compared."""
        a, b = [], []
        while x is not y:  # both have as many steps
            a.append(x[2])
            b.append(y[2])
            x, y = x[0], y[0]
        return "".join(map(text_of, reversed(a))) < "".join(map(text_of, reversed(b)))

    def step(self, matrix: list[list]) -> None:
        new: list = [None] * 4
        for j in range(4):
            for i in range(4):
                if self.best[i] and matrix[i][j]:
                    way = (self.best[i][0] + matrix[i][j][0], (self.best[i][1], i, matrix[i][j][1]))
                    if new[j] is None or way[0] < new[j][0] or (way[0] == new[j][0] and self._before(way[1], new[j][1])):
                        new[j] = way
        self.best = new

    def end(self, closing: list[list]) -> tuple[int, list[tuple[int, str]]]:
        """The cost, and for each step the state before it and its part of the audit; the last part is the closing inserts."""
        self.step(closing)
        ways = [self.best[j] for j in _ENDING if self.best[j]]
        best = ways[0]
        for w in ways[1:]:
            if w[0] < best[0] or (w[0] == best[0] and self._before(w[1], best[1])):
                best = w
        parts, node = [], best[1]
        while node is not None:
            parts.append((node[1], text_of(node[2])))
            node = node[0]
        return best[0], parts[::-1]


# ---- rows ---------------------------------------------------------------------------------------

def first_fault(text: str, repeated: bool) -> str:
    """blank, duplicate, truncated or nothing."""
    text = text.rstrip(_SPACE)
    if not text:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if text[-1] in _ENDS else "truncated"


def symbol(role: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return "-"
    c = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return c.upper() if fault == "truncated" else c


def apply_audit(audit: str, state: int, rows: Iterable[tuple[str, str]]) -> list[str]:
    """The repaired ``role:text`` lines."""
    out, rows = [], iter(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else next(rows)
        if e == "D":
            continue
        state = SYSTEM if e == "K" and role[:1] == "s" else _NEXT[state]
        out.append(f"{role if e == 'K' else _ROLE[state]}:{text}")
    return out


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): a table of conversations with faults put in, by a checksum of id and turn.

    Of twenty values 0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it and
    4 makes it a user's.  ``n`` is how often a row stands (0 for a dropped one, so that its conversation
    stays known).  A null role or text is one space, as are a null id and turn in the checksum.
    """
    one = F.lit(" ")
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), one).alias("role"), F.coalesce(F.col("text").cast("string"), one).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", _ENDS, "")).otherwise(F.col("text"))
    return r.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"))


# ---- pieces -------------------------------------------------------------------------------------

_PIECE = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("open", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())),
                    ("texts", pa.list_(pa.string())), ("symbols", pa.string()), ("faults", pa.list_(pa.int64()))])
_PIECE_SQL = "conv_id long, at long, open boolean, turns array<long>, roles array<string>, texts array<string>, symbols string, faults array<long>"


def _judged(roles: list[str], texts: list[str], repeated) -> tuple[str, list[int]]:
    """The symbols of rows in order and how many are blank, duplicate and truncated; ``repeated`` tells of (place, role, text)."""
    kinds = [first_fault(t, repeated(k, r, t)) for k, (r, t) in enumerate(zip(roles, texts, strict=True))]
    c = Counter(kinds)
    return "".join(map(symbol, roles, kinds)), [c["blank"], c["duplicate"], c["truncated"]]


def _seen_here():
    seen = set()

    def repeated(_, role, text):
        if (role, text) in seen:
            return True
        seen.add((role, text))
        return False

    return repeated


def _pieces(rows: DataFrame, piece_rows: int, piece_bytes: int) -> DataFrame:
    """Conversations in pieces of consecutive rows.

    Rows are ordered over all partitions by conversation, turn (nulls first), role and text, so a conversation
    of any size is spread evenly.  Most conversations are one piece; the first and
    last of a partition, and those cut for their size, are marked open and put together later.
    """
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 256)).sortWithinPartitions("conv_id", "turn", "role", "text")

    def cut(batches):
        part = TaskContext.get().partitionId() << 32
        number, held, size = 0, None, 0
        first = cut_before = True

        def piece(is_open):
            nonlocal number
            conv, turns, roles, texts = held
            symbols, faults = (None, None) if is_open else _judged(roles, texts, _seen_here())
            number += 1
            return {"conv_id": conv, "at": part + number, "open": is_open, "turns": turns, "roles": roles, "texts": texts, "symbols": symbols, "faults": faults}

        for b in slices(batches):
            out = []
            for conv, turn, role, text, n in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                if held is None or held[0] != conv:
                    if held is not None:
                        out.append(piece(first or cut_before))
                        first = False
                    held, size, cut_before = (conv, [], [], []), 0, False
                for _ in range(n):
                    if len(held[1]) >= piece_rows or size >= piece_bytes:
                        out.append(piece(True))
                        held, size, cut_before = (conv, [], [], []), 0, True
                    held[1].append(turn)
                    held[2].append(role)
                    held[3].append(text)
                    size += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
        if held is not None:
            yield pa.RecordBatch.from_pylist([piece(True)], schema=_PIECE)

    return ranged.mapInArrow(cut, _PIECE_SQL)


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


def _open_pieces(pieces: DataFrame) -> DataFrame:
    """The open pieces with symbols and faults: a row is a duplicate unless no earlier row of its conversation, in any piece, has its digest."""
    def digests(batches):
        for b in slices(batches):
            conv, at, place, digest = [], [], [], []
            for r in b.to_pylist():
                seen = {}
                for k, (role, text) in enumerate(zip(r["roles"], r["texts"], strict=True)):
                    seen.setdefault(_digest(role, text), k)
                conv += [r["conv_id"]] * len(seen)
                at += [r["at"]] * len(seen)
                place += seen.values()
                digest += seen
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(at, pa.int64()), pa.array(place, pa.int32()), pa.array(digest, pa.binary())],
                                             names=["conv_id", "at", "place", "digest"])

    found = pieces.where("open").select("conv_id", "at", "roles", "texts").mapInArrow(digests, "conv_id long, at long, place int, digest binary")
    firsts = found.groupBy("conv_id", "digest").agg(F.min(F.struct("at", "place")).alias("x")).groupBy(F.col("x.at").alias("at")).agg(F.collect_list("x.place").alias("firsts"))

    def judge(batches):
        for b in slices(batches):
            out = []
            for r in b.to_pylist():
                mine = set(r.pop("firsts") or ())
                r["symbols"], r["faults"] = _judged(r["roles"], r["texts"], lambda k, *_, mine=mine: k not in mine)
                out.append(r)
            yield pa.RecordBatch.from_pylist(out, schema=_PIECE)

    return pieces.where("open").join(firsts, "at", "left").select(*_PIECE.names, "firsts").mapInArrow(judge, _PIECE_SQL)


# ---- grammar ------------------------------------------------------------------------------------

def learn_grammar(sequences: DataFrame, rounds: int = 10, least: int = 2) -> Grammar:
    """Re-Pair over (symbols, n) rows, the distinct sequences and how often they stand.

    A round counts the neighbouring pairs of all compressed sequences and makes rules of the most
    frequent ones that share no symbol, so their order doesn't matter; it ends when no
    pair stands ``least`` times, or after ``rounds``.  A round's counts are at most the square of its
    symbols, which the rounds bound.  Rules save work; results don't depend on them.
    """
    grammar = Grammar()
    for _ in range(rounds):
        rules = list(grammar.rules)

        def count(batches, rules=rules):
            known, sums = Grammar(rules), defaultdict(int)
            for b in batches:
                for symbols, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    s, skip = known.compress(symbols), None
                    for k in range(len(s) - 1):
                        if s[k] == s[k + 1] and skip == k:  # aaa has the pair aa once
                            continue
                        skip = k + 1 if s[k] == s[k + 1] else None
                        sums[str(s[k]), str(s[k + 1])] += n
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in sums], pa.string()), pa.array([y for _, y in sums], pa.string()), pa.array(sums.values(), pa.int64())],
                                             names=["x", "y", "n"])

        pairs = sequences.mapInArrow(count, "x string, y string, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        taken = set()
        for r in pairs.orderBy(F.desc("n"), "x", "y").collect():
            x, y = (int(s) if s.isdigit() else s for s in (r["x"], r["y"]))
            if not taken & {x, y}:
                taken |= {x, y}
                grammar.add((x, y))
        if not taken:
            break
    return grammar


# ---- conversations ------------------------------------------------------------------------------

_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [x.split()[0] for x in _RESULT.split(", ")]
_RESULT_ARROW = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in _NAMES])


class _Order:
    """Turns and neighbours of rows in order, put together piece by piece."""

    def __init__(self):
        self.low = self.high = self.last_turn = self.last_role = None
        self.turns = self.illegal = 0

    def add(self, low, high, turns, first_role, last_role, illegal):
        if low is not None:
            self.turns += turns - (low == self.last_turn)  # turns ascend
            self.low = low if self.low is None else self.low
            self.high = self.last_turn = high
        if first_role is not None:
            self.illegal += illegal + (self.last_role is not None and self.last_role + first_role not in _LEGAL)
            self.last_role = last_role

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _summary(turns: list, roles: list[str]) -> tuple:
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    return (known[0] if known else None, known[-1] if known else None, len(set(known)),
            initials[0] if roles else None, initials[-1] if roles else None, illegal)


def repair(rows: DataFrame, piece_rows: int = 1024, piece_bytes: int = 1 << 20, rounds: int = 10) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation.

    ``rows`` has conv_id, turn, role, text and n, how often the row stands (see :func:`damage`); conversations
    whose rows all have n = 0 have zeros, an empty audit and the hash of nothing.  Rows go by turn, nulls
    first, then role, then text.  Null ids are one conversation.  Blank, duplicate and truncated count rows by their first
    fault, ``illegal`` neighbours whose role initials are not su, ua or au, ``gaps`` the turns missing
    between the first and the last.  ``audit`` spells the cheapest edits (K keep, R make user or assistant, D
    delete, I insert) that give role initials ``(s?(ua)+)?``, of equal cost the least text.  An empty table gives no rows; other columns are ignored.

    Long conversations are cut into pieces of ``piece_rows`` rows or ``piece_bytes`` characters.  Their
    pieces' matrices and their repaired lines are put together in order in one task each, which holds a
    piece and the audit (a value of the result) at a time: a hash over a whole conversation can't be taken in parts.
    Rows that are equal in id, turn, role and the text's first 256 characters are ordered by one task.
    """
    pieces = write_shared(_pieces(rows, piece_rows, piece_bytes), "conversation-pieces")
    parts = write_shared(_open_pieces(pieces), "conversation-open")
    seqs = pieces.where("not open").select("symbols").union(parts.select("symbols")).groupBy("symbols").agg(F.count("*").alias("n"))
    spark = rows.sparkSession
    grammar = learn_grammar(write_shared(seqs, "conversation-sequences"), rounds)
    rules = spark.sparkContext.broadcast(list(grammar.rules))

    def closed(batches):
        grammar, known = Grammar(rules.value), {}
        for b in slices(batches):
            out = []
            for r in b.to_pylist():
                s = r["symbols"]
                if s not in known:
                    if len(known) > 50_000:
                        known.clear()
                    known[s] = grammar.repair(s)
                cost, audit = known[s]
                order = _Order()
                order.add(*_summary(r["turns"], r["roles"]))
                lines = apply_audit(audit, START, zip(r["roles"], r["texts"], strict=True))
                out.append((r["conv_id"], order.gaps, *r["faults"], order.illegal, cost, audit, hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()))
            yield _batch(out, _RESULT_ARROW)

    whole = pieces.where("not open").select("conv_id", "turns", "roles", "texts", "symbols", "faults").mapInArrow(closed, _RESULT)
    return whole.unionByName(_repair_open(parts, rules))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_ENTRY = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_PART = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n_turns", pa.int64()), ("first_role", pa.string()),
                   ("last_role", pa.string()), ("illegal", pa.int64()), ("faults", pa.list_(pa.int64())), ("matrix", _ENTRY)])
_PART_SQL = ("conv_id long, at long, low long, high long, n_turns long, first_role string, last_role string, illegal long, faults array<long>, "
             "matrix array<struct<cost: long, audit: string>>")
_STEP = pa.schema([*_RESULT_ARROW, ("at", pa.int64()), ("state", pa.int32()), ("step", pa.string()), ("closing", pa.string()), ("closing_state", pa.int32())])
_STEP_SQL = f"{_RESULT}, at long, state int, step string, closing string, closing_state int"


def _repair_open(parts: DataFrame, rules) -> DataFrame:
    """The conversations that lie in several partitions or pieces."""
    def matrices(batches):
        grammar = Grammar(rules.value)
        for b in slices(batches):
            out = []
            for r in b.to_pylist():
                m = [x and {"cost": x[0], "audit": x[1]} for row in grammar.whole(r["symbols"]) for x in row] if r["symbols"] else None
                out.append((r["conv_id"], r["at"], *_summary(r["turns"], r["roles"]), r["faults"], m))
            yield _batch(out, _PART)

    def fold(batches):
        """Each conversation's totals beside its last piece, and each piece's part of the audit."""
        closing, held = _inserts(), None

        def finish():
            conv, way, order, faults, ats = held
            cost, steps = way.end(closing)
            audit = "".join(a for _, a in steps)
            live = iter(steps[:-1])
            rows = [(conv, *[None] * 8, at, *(next(live) if used else (None, None)), None, None) for at, used in ats]
            rows[-1] = (conv, order.gaps, *faults, order.illegal, cost, audit, None, *rows[-1][9:12], steps[-1][1], steps[-1][0])
            for k in range(0, len(rows), 1024):
                yield _batch(rows[k : k + 1024], _STEP)

        for b in slices(batches):
            for r in b.to_pylist():
                if held is None or held[0] != r["conv_id"]:
                    if held is not None:
                        yield from finish()
                    held = (r["conv_id"], Way(), _Order(), [0, 0, 0], [])
                _, way, order, faults, ats = held
                m = r["matrix"]
                if m is not None:
                    way.step([[x and (x["cost"], x["audit"]) for x in m[4 * i : 4 * i + 4]] for i in range(4)])
                order.add(r["low"], r["high"], r["n_turns"], r["first_role"], r["last_role"], r["illegal"])
                faults[:] = [a + x for a, x in zip(faults, r["faults"], strict=True)]
                ats.append((r["at"], m is not None))
        if held is not None:
            yield from finish()

    def digest(batches):
        held = None  # conversation, hash so far, whether it has a line, totals
        for b in slices(batches):
            out = []
            for r in b.to_pylist():
                if held is None or held[0] != r["conv_id"]:
                    held = (r["conv_id"], hashlib.sha256(), [False])
                _, h, any_line = held
                lines = apply_audit(r["step"] or "", r["state"] or START, zip(r["roles"], r["texts"], strict=True))
                if r["closing"]:
                    lines += apply_audit(r["closing"], r["closing_state"], ())
                for line in lines:
                    h.update(("\n" * any_line[0] + line).encode("utf-8", "surrogatepass"))
                    any_line[0] = True
                if r["audit"] is not None:
                    out.append((*(r[n] for n in _NAMES[:-1]), h.hexdigest()))
            yield _batch(out, _RESULT_ARROW)

    def ordered(df):
        return df.repartition("conv_id").sortWithinPartitions("conv_id", "at")

    summed = parts.select("conv_id", "at", "turns", "roles", "symbols", "faults").mapInArrow(matrices, _PART_SQL)
    steps = write_shared(ordered(summed).mapInArrow(fold, _STEP_SQL), "conversation-steps").drop("repaired_sha256", "conv_id")
    joined = parts.select("conv_id", "at", "roles", "texts").join(steps, "at")
    return ordered(joined).mapInArrow(digest, _RESULT)
