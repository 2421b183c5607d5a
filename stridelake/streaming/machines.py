"""State machines over the events of a key, in order.

A machine has a state that json can hold, `start()` for a new key and `step(state, row)`, which changes the
state and returns output rows as dicts. runner.py runs it over tables and streams."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field


@dataclass
class Latest:
    """The latest value of each channel; a row comes out for each event at which all channels are fresh, or,
    with `barrier`, once all have been seen."""

    channels: Sequence[str]
    timeout: float
    barrier: bool = False
    output: str = "t double, values map<string,double>"

    def start(self) -> dict:
        return {}

    def step(self, state: dict, row: dict) -> list[dict]:
        if row["channel"] in self.channels:
            state[row["channel"]] = [row["t"], row["value"]]
        seen = all(c in state for c in self.channels)
        fresh = seen and all(row["t"] - state[c][0] <= self.timeout for c in self.channels)
        return [{"t": row["t"], "values": {c: state[c][1] for c in self.channels}}] if (seen if self.barrier else fresh) else []


@dataclass
class Broker:
    """Plays chunks step by step: a new chunk is asked for when none is held, and dropped after `horizon` steps."""

    horizon: int
    output: str = "t double, chunk long, index int, asks boolean"

    def start(self) -> dict:
        return {"chunk": -1, "index": 0}

    def step(self, state: dict, row: dict) -> list[dict]:
        asks = state["chunk"] < 0 or state["index"] == self.horizon
        if asks:
            state.update(chunk=state["chunk"] + 1, index=0)
        state["index"] += 1
        return [{"t": row["t"], "chunk": state["chunk"], "index": state["index"] - 1, "asks": asks}]


@dataclass
class IfNew:
    """Passes events whose mark differs from the one before."""

    output: str = "t double, mark string"

    def start(self) -> dict:
        return {"mark": None, "any": False}

    def step(self, state: dict, row: dict) -> list[dict]:
        new = not state["any"] or state["mark"] != row["mark"]
        state.update(mark=row["mark"], any=True)
        return [{"t": row["t"], "mark": row["mark"]}] if new else []


@dataclass
class Newer:
    """Passes an event only if it is newer than all before it, as a reader does that waits for the next frame."""

    output: str = "t double"

    def start(self) -> dict:
        return {"last": None}

    def step(self, state: dict, row: dict) -> list[dict]:
        if state["last"] is not None and row["t"] <= state["last"]:
            return []
        state["last"] = row["t"]
        return [{"t": row["t"]}]


@dataclass
class EveryNth:
    """Passes each n-th event."""

    n: int
    output: str = "t double, count long"

    def start(self) -> dict:
        return {"count": 0}

    def step(self, state: dict, row: dict) -> list[dict]:
        state["count"] += 1
        return [{"t": row["t"], "count": state["count"]}] if state["count"] % self.n == 0 else []


@dataclass
class Throttle:
    """Passes an event unless one was passed less than the interval before."""

    interval: float
    output: str = "t double"

    def start(self) -> dict:
        return {"last": None}

    def step(self, state: dict, row: dict) -> list[dict]:
        if state["last"] is not None and row["t"] - state["last"] < self.interval:
            return []
        state["last"] = row["t"]
        return [{"t": row["t"]}]


@dataclass
class Converged:
    """Whether the error has been below the tolerance for so long without a break."""

    tolerance: float
    seconds: float
    output: str = "t double, converged boolean"

    def start(self) -> dict:
        return {"since": None}

    def step(self, state: dict, row: dict) -> list[dict]:
        if row["value"] >= self.tolerance:
            state["since"] = None
        elif state["since"] is None:
            state["since"] = row["t"]
        return [{"t": row["t"], "converged": state["since"] is not None and row["t"] - state["since"] >= self.seconds}]


@dataclass
class Relay:
    """Proportional control towards the latest command: rows with `command` set it, rows with `measured` are
    answered. A command older than command_timeout is dropped; a measurement that comes state_timeout after
    the one before gets no answer, but keeps the command."""

    gain: float
    limit: float
    command_timeout: float = 0.5
    state_timeout: float = 0.2
    output: str = "t double, velocity double"

    def start(self) -> dict:
        return {"command": None, "at": 0.0, "measured_at": None}

    def step(self, state: dict, row: dict) -> list[dict]:
        if row["command"] is not None:
            state.update(command=row["command"], at=row["t"])
        if row["measured"] is None:
            return []
        late = state["measured_at"] is not None and row["t"] - state["measured_at"] > self.state_timeout
        state["measured_at"] = row["t"]
        if state["command"] is not None and row["t"] - state["at"] > self.command_timeout:
            state["command"] = None
        if late or state["command"] is None:
            return []
        return [{"t": row["t"], "velocity": max(-self.limit, min(self.limit, self.gain * (state["command"] - row["measured"])))}]


@dataclass
class History:
    """Server-held chunks: a request names the chunk that it continues, 0 for none. A stale name is an error
    row; else the previous chunk's id and first step come back and a new id is given. `reset` clears."""

    output: str = "t double, chunk long, continues long, from_step int, error string"

    def start(self) -> dict:
        return {"chunk": 0}

    def step(self, state: dict, row: dict) -> list[dict]:
        if row["reset"]:
            state["chunk"] = 0
            return []
        out = {"t": row["t"], "chunk": None, "continues": None, "from_step": None, "error": None}
        if row["previous"] and row["previous"] != state["chunk"]:
            return [out | {"error": f"chunk {row['previous']} is stale; {state['chunk']} is held"}]
        state["chunk"] += 1
        return [out | {"chunk": state["chunk"], "continues": row["previous"] or None, "from_step": row["prefix_start"] if row["previous"] else None}]


@dataclass
class Session:
    """A server's side of a client's messages. `connect` opens a session, whose first message is the metadata; each
    request gets its `answer` with its time and the whole time of the answer before. A request without an answer
    gets an error, which closes the session; until the next `connect` nothing is answered. A health check is
    answered in any state and changes none."""

    metadata: str = "{}"
    health: str = "/healthz"
    output: str = "t double, kind string, body string, infer_ms double, prev_total_ms double"

    def start(self) -> dict:
        return {"open": False, "total": None}

    def step(self, state: dict, row: dict) -> list[dict]:
        def message(kind: str, body: str, infer_ms: float | None = None, prev_total_ms: float | None = None) -> dict:
            return {"t": row["t"], "kind": kind, "body": body, "infer_ms": infer_ms, "prev_total_ms": prev_total_ms}

        if row["path"] == self.health:
            return [message("health", "OK\n")]
        out = []
        if row["connect"]:
            state.update(open=True, total=None)
            out.append(message("metadata", self.metadata))
        if not state["open"]:
            return out
        if row["answer"] is None:
            state["open"] = False
            return [*out, message("error", "the request can't be read")]
        out.append(message("answer", row["answer"], row["infer_ms"], state["total"]))
        state["total"] = row["total_ms"]
        return out


@dataclass
class Splice:
    """Overlapping chunks without a stall: each row is one control step, with the latency in steps that a
    request issued at it would have.

    The first step waits for a chunk. Later a request goes out `delay` steps before the execution horizon
    ends; its chunk is indexed from the step of the request, so at arrival index `real delay` is the next
    step to run. When nothing is left the step waits for the request under way. Every step runs exactly once.
    With adapt, delay follows the quantile of the last observed ones, plus a margin."""

    chunk: int
    horizon: int
    delay: int
    adapt: int = 0
    quantile: float = 1.0
    margin: int = 0
    scale: float = 2.0
    least: int = 1
    output: str = "step long, chunk_id long, index int, chunk_step long, waited int, delay int, horizon int"
    _: None = field(default=None, repr=False)

    def start(self) -> dict:
        return {"step": -1, "id": 0, "origin": 0, "cursor": 0, "asked": None, "due": 0, "last": 0, "delay": self.delay, "horizon": self.horizon, "seen": [], "next": 0}

    def _install(self, s: dict, step: int, waited: int) -> None:
        real = step - s["asked"] + waited
        s["seen"] = (s["seen"] + [real])[-max(1, self.adapt) :]
        s["id"], s["origin"], s["cursor"], s["asked"] = s["next"], s["asked"], step - s["asked"], None
        s["cursor"] = min(s["cursor"], self.chunk)
        if self.adapt:
            ordered = sorted(s["seen"])
            at = self.quantile * (len(ordered) - 1)
            low = math.floor(at)
            q = ordered[low] + (ordered[min(low + 1, len(ordered) - 1)] - ordered[low]) * (at - low)
            s["delay"] = max(0, min(math.ceil(q - 1e-9) + self.margin, self.chunk - 1))
            s["horizon"] = max(s["delay"] + 1, min(max(round(self.scale * s["delay"]), self.least), self.chunk))

    def step(self, state: dict, row: dict) -> list[dict]:
        s, waited = state, 0
        s["step"] += 1
        step = s["step"]
        if step == 0:
            s["id"] = s["next"] = 1
            waited = row["latency"]
        else:
            if s["asked"] is not None and step >= s["due"]:
                self._install(s, step, 0)
            if s["asked"] is None and step - s["last"] >= max(s["horizon"] - s["delay"], 1):
                s["asked"], s["last"], s["due"] = step, step, step + row["latency"]
                s["next"] += 1
            if s["cursor"] >= self.chunk:
                waited = max(0, s["due"] - step)
                self._install(s, step, waited)
        out = {"step": step, "chunk_id": s["id"], "index": s["cursor"], "chunk_step": s["origin"] + s["cursor"], "waited": waited, "delay": s["delay"], "horizon": s["horizon"]}
        s["cursor"] += 1
        return [out]


@dataclass
class Runtime:
    """Episodes of at most max_steps steps, or until an event says done; exactly max_steps run."""

    max_steps: int
    output: str = "t double, episode long, step long"

    def start(self) -> dict:
        return {"episode": 0, "step": 0}

    def step(self, state: dict, row: dict) -> list[dict]:
        out = {"t": row["t"], "episode": state["episode"], "step": state["step"]}
        state["step"] += 1
        if row["done"] or state["step"] >= self.max_steps:
            state.update(episode=state["episode"] + 1, step=0)
        return [out]
