"""A causal self-attention model over subword classes, in numpy: training by Adam and scoring by overlapping windows.

Subword ids are folded into GROUPS groups of MEMBERS classes by frequency; a group holds either ids that begin a word
(or end the text) or ids that go on with one. The commonest ids have a class of their own, the others share classes of
equal mass. log p(id | context) = log p(group | context) + log p(class | group, context) + log p(id | class); the model
gives the first two, counts the last. The groups' kinds also give the probability that a word is over. Each window holds
OVERLAP tokens of context and SCORED tokens that it scores, so each token is scored once, with OVERLAP tokens or more
before it.
"""

from __future__ import annotations

import contextlib
import ctypes
from pathlib import Path

import numpy as np

OVERLAP, SCORED = 8, 24
WIDTH, HIDDEN, GROUPS, MEMBERS = 16, 32, 32, 32
#: Share of the classes that hold one id.
SINGLE = 0.75
#: Steps of training in each task, over all rounds; windows of a batch, and of one where there are many; the first rate.
STEPS, BATCH, WIDE, RATE = 2_000, 32, 256, 8e-3
#: Training by parts goes in so many rounds at most, each of so many tasks at least.
ROUNDS, TASKS = 10, 3
#: Windows that a pass takes, so few that what it makes stays in a core's cache.
BLOCK = 64
#: The greatest logit, as a power of two.
MOST = 100.0

_W = OVERLAP + SCORED
#: A token sees itself and what stands before it, not more than OVERLAP + its place in the window.
_MASK = np.where(np.arange(_W)[None, :] <= np.arange(OVERLAP, _W)[:, None], 0.0, -1e9).astype(np.float32)

_SEEN = (_MASK == 0).astype(np.float32)

def one_thread() -> None:
    """Let numpy's own OpenBLAS use one thread: the products here are small, and a task has one core. Let glibc keep freed
    memory, as each pass takes the same again."""
    for lib in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(str(lib)).scipy_openblas_set_num_threads64_(1)
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD


class Folding:
    """class_of: class of each id, its group times MEMBERS and its place there; log_in: log p(id | class).

    counts: of each id in the learning texts; begins: whether the id begins a word or ends a text. The first `first`
    groups are those of ids that begin; the others' shares of the groups follow the counts."""

    def __init__(self, counts: np.ndarray, begins: np.ndarray, groups: int = GROUPS, members: int = MEMBERS):
        smooth = counts + 0.5
        share = smooth[begins].sum() / smooth.sum()
        self.first = int(np.clip(round(groups * share), 1, groups - 1))
        self.class_of, self.members = np.zeros(len(counts), np.int16), members
        for kind, at, n in ((begins, 0, self.first * members), (~begins, self.first * members, (groups - self.first) * members)):
            ids = np.flatnonzero(kind)
            ids = ids[np.argsort(-counts[ids], kind="stable")]
            single = int(n * SINGLE) if len(ids) > n else len(ids)
            self.class_of[ids[:single]] = at + np.arange(single)
            rest = ids[single:]
            if len(rest):
                mass = np.cumsum(smooth[rest])
                self.class_of[rest] = at + single + np.minimum((mass / mass[-1] * (n - single)).astype(int), n - single - 1)
        total = np.bincount(self.class_of, smooth, groups * members)
        self.log_in = np.log(smooth / total[self.class_of])
        self.used = total > 0  # the other classes are never predicted
        self.pad = groups * members  # stands before a text and after its end


def windows(classes: np.ndarray, start: int, pad: int) -> np.ndarray:
    """Rows of inputs for the tokens of one text: row j scores tokens j * SCORED and on. start: class before the text."""
    n = -(-len(classes) // SCORED) * SCORED
    x = np.full(OVERLAP + n, pad, np.int16)
    x[OVERLAP] = start
    x[OVERLAP + 1 : OVERLAP + len(classes)] = classes[:-1]
    return np.lib.stride_tricks.sliding_window_view(x, _W)[::SCORED]


def spans(classes: np.ndarray, before: int, pad: int) -> np.ndarray:
    """The windows of a text or a part of one, each with one more token, so that a row holds inputs and targets (see
    unspan()). before: the class of what stands before it."""
    return all_spans(classes, np.array([len(classes)]), np.array([before]), pad)[0]


def all_spans(classes: np.ndarray, sizes: np.ndarray, before: np.ndarray, pad: int, order=None) -> tuple[np.ndarray, np.ndarray]:
    """spans() of many parts, whose tokens stand one after the other, and the number of the first row of each. order: gives
    the order of the rows from their number."""
    n = -(-sizes // SCORED)
    size = OVERLAP + 1 + n * SCORED
    at, first = np.cumsum(size) - size, np.cumsum(n) - n
    x = np.full(int(size.sum()), pad, np.int16)
    x[at + OVERLAP] = before
    x[np.arange(len(classes)) + np.repeat(at + OVERLAP + 1 - (np.cumsum(sizes) - sizes), sizes)] = classes
    rows = np.repeat(at - first * SCORED, n) + np.arange(int(n.sum())) * SCORED
    if not len(rows):
        return np.empty((0, _W + 1), np.int16), first
    return np.lib.stride_tricks.sliding_window_view(x, _W + 1)[rows if order is None else rows[order(len(rows))]], first


def unspan(rows: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets, -1 where nothing is to be learnt."""
    y = rows[:, OVERLAP + 1 :]
    return rows[:, :-1], np.where(y == pad, np.int16(-1), y)


class Attention:
    """used: classes that hold ids; the others get no probability."""

    def __init__(self, seed: int = 7, groups: int = GROUPS, members: int = MEMBERS, used: np.ndarray | None = None):
        r = np.random.default_rng(seed)
        d, h, g, m = WIDTH, HIDDEN, groups, members
        init = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
        self.groups, self.members = g, m
        used = np.ones(g * m, bool) if used is None else used
        self.off = np.where(used, 0, -1e4).astype(np.float32).reshape(g, m)
        self.off_group = np.where(used.reshape(g, m).any(1), 0, -1e4).astype(np.float32)
        self.p = {
            "e": (r.standard_normal((g * m + 1, d)) * 0.3).astype(np.float32), "pos": init(_W, d) * 0.5, "q": init(d, d), "k": init(d, d), "v": init(d, d), "o": init(d, d) * 0.5, "w1": init(d, h), "b1": np.zeros(h, np.float32), "w2": init(h, d) * 0.5,
            "u": init(d, g), "bu": np.zeros(g, np.float32), "u2": init(g, d, m), "bu2": np.zeros((g, m), np.float32),
        }
        self.first, self.second = ({n: np.zeros_like(w) for n, w in self.p.items()} for _ in range(2))

    def hidden(self, x: np.ndarray):
        """What the heads read, (rows * SCORED, WIDTH), of windows x, step by step, and the steps; forward() is compared with it."""
        p = self.p
        e = p["e"][x] + p["pos"]
        tail = e[:, OVERLAP:]
        q, k, v = tail @ p["q"], e @ p["k"], e @ p["v"]
        a = q @ k.transpose(0, 2, 1)
        a *= np.float32(1 / np.sqrt(WIDTH))
        a += _MASK
        a -= a.max(-1, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(-1, keepdims=True)
        z = a @ v
        h = (tail + z @ p["o"]).reshape(-1, WIDTH)
        m = h @ p["w1"]
        m += p["b1"]
        np.maximum(m, 0, out=m)
        return h + m @ p["w2"], (e, tail, q, k, v, a, z, h, m)

    def tables(self, first: int | None = None) -> tuple:
        """What forward() and heads() read. The products of queries with keys and of values with what reads them are one
        matrix each; a column of ones sums weights or adds biases; powers of two stand for exponentials. The heads' weights
        are centred over the used classes of a group and over the used groups, of either kind with `first`, which keeps the
        sums of powers over 1; the kinds' own weights go beside them."""
        p, log2e = self.p, 1 / np.log(2)
        e = np.ones((len(p["e"]), WIDTH + 1), p["e"].dtype)
        e[:, :WIDTH] = p["e"]
        pos = np.zeros((_W, WIDTH + 1), e.dtype)
        pos[:, :WIDTH] = p["pos"]
        u, u2 = np.vstack([p["u"], p["bu"]]) * log2e, np.concatenate([p["u2"], p["bu2"][:, None]], 1) * log2e
        on, on2, kinds = (self.off_group == 0).astype(e.dtype), (self.off == 0).astype(e.dtype), np.zeros((WIDTH + 1, 4), e.dtype)  # two are in use: products with fewer columns are slow
        for k, of in enumerate((slice(0, first), slice(first or self.groups, None))):
            kinds[:, k] = u[:, of] @ on[of] / max(1, on[of].sum())
            u[:, of] -= kinds[:, k : k + 1]
        u2 -= u2 @ on2[:, :, None] / np.maximum(1, on2.sum(1))[:, None, None]
        u[-1] += self.off_group
        u2[:, -1] += self.off
        qk, vo = p["q"] @ p["k"].T * (log2e / np.sqrt(WIDTH)), p["v"] @ p["o"]
        return tuple(np.ascontiguousarray(w, e.dtype) for w in (e, pos, qk, vo, np.vstack([p["w1"], p["b1"]]), u, u2, kinds))

    def turned(self, tables: tuple) -> tuple:
        """Transposes that the backward pass reads."""
        p = self.p
        return tuple(map(np.ascontiguousarray, (p["u"].T, p["u2"].transpose(0, 2, 1), p["w2"].T, p["w1"].T, tables[3].T, tables[2].T * tables[2].dtype.type(np.log(2)))))

    def forward(self, tables: tuple, x: np.ndarray) -> tuple:
        """The same sums as hidden(), each with a last column of ones, and what the backward pass needs."""
        table, pos, qk, vo, w1 = tables[:5]
        d, n = WIDTH, len(x)
        e = np.take(table, x, axis=0)
        e += pos
        tail = np.ascontiguousarray(e[:, OVERLAP:, :d])
        q = (tail.reshape(-1, d) @ qk).reshape(tail.shape)
        both = np.empty((n, 2 * SCORED, _W), e.dtype)  # the weights' gradients come before the weights
        a = np.matmul(q, e[:, :, :d].transpose(0, 2, 1), out=both[:, SCORED:])
        np.clip(a, -MOST, MOST, out=a)
        np.exp2(a, out=a)
        a *= _SEEN
        z = (a @ e).reshape(-1, d + 1)  # the last column sums the weights
        s = z[:, d:]
        z = z[:, :d] / s
        tail = tail.reshape(-1, d)
        h, h2 = np.ones((n * SCORED, d + 1), e.dtype), np.ones((n * SCORED, d + 1), e.dtype)
        np.add(tail, z @ vo, out=h[:, :d])
        m = h @ w1
        np.maximum(m, 0, out=m)
        np.add(h[:, :d], m @ self.p["w2"], out=h2[:, :d])
        return h2, (e, tail, q, both, s, z, h, m)

    def heads(self, tables: tuple, read: np.ndarray, own: np.ndarray, place: np.ndarray, first: int | None = None) -> tuple:
        """Of rows in the order of their groups: log2 p(class); log2 p of the first groups (None without `first`); powers and
        their sums of the groups' logits and of the classes' in the own group; the groups' slices. Logits over MOST count
        as MOST, so that nothing overflows."""
        u, u2, kinds = tables[5:]
        i, opens, one = np.arange(len(own)), None, np.zeros(self.groups, read.dtype)
        outer = read @ u
        np.minimum(outer, MOST, out=outer)
        got = np.take(outer, i * self.groups + own)
        np.exp2(outer, out=outer)
        one[:first] = 1
        total = outer @ one
        if first is None:
            got -= np.log2(total)
        else:
            of = np.ascontiguousarray((read @ kinds).T)
            at = np.searchsorted(own, first)
            got[:at] += of[0, :at]
            got[at:] += of[1, at:]
            with np.errstate(divide="ignore"):  # there may be no groups of the other kind
                one, other = of[0] + np.log2(total), of[1] + np.log2(outer @ (1 - one))
            both = np.maximum(one, other) + np.log2(1 + np.exp2(-np.abs(one - other)))
            got -= both
            opens = one - both
        cuts = np.searchsorted(own, np.arange(self.groups + 1)).tolist()
        parts = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        inner = np.empty((len(own), self.members), read.dtype)
        for k, rows in parts:
            np.dot(read[rows], u2[k], out=inner[rows])
        np.minimum(inner, MOST, out=inner)
        got += np.take(inner, i * self.members + place)
        np.exp2(inner, out=inner)
        within = inner @ np.ones(self.members, read.dtype)
        got -= np.log2(within)
        return got, opens, outer, total, inner, within, parts

    def by_group(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places that are scored, in the order of their groups, so that each group's rows are one slice; groups, classes."""
        t = y.reshape(-1)
        on = np.flatnonzero(t >= 0)
        t = t[on]
        g = t // self.members
        m = t - g * self.members
        order = np.argsort(g.astype(np.int16), kind="stable")
        return on[order], g[order], m[order]

    def log_probs(self, x: np.ndarray, y: np.ndarray, first: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(log p(y), log p of the first `first` groups) for each scored place; y: (rows, SCORED), -1 where nothing is to
        be scored, which gives 0."""
        one_thread()
        tables, ln2 = self.tables(first), np.float32(np.log(2))
        out, begins = np.zeros(y.size, np.float32), np.zeros(y.size, np.float32)
        for i in range(0, len(x), BLOCK):
            on, g, m = self.by_group(y[i : i + BLOCK])
            h = self.forward(tables, x[i : i + BLOCK])[0]
            got, opens = self.heads(tables, np.take(h, on, axis=0), g, m, first)[:2]
            out[i * SCORED + on] = got * ln2
            begins[i * SCORED + on] = opens * ln2
        return out.reshape(y.shape), begins.reshape(y.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """The mean loss of the windows' targets and its gradient, summed over blocks."""
        tables, scale = self.tables(), 1 / max(1, np.count_nonzero(y >= 0))
        turned, loss, g, de = self.turned(tables), 0.0, {}, np.empty((len(x), _W, WIDTH), tables[0].dtype)
        for i in range(0, len(x), BLOCK):
            part, got = self._block(tables, turned, x[i : i + BLOCK], y[i : i + BLOCK], de[i : i + BLOCK])
            loss += part
            for n, w in got.items():
                g[n] = np.add(g[n], w, out=g[n]) if n in g else w
        g["pos"] = de.sum(0)
        ind = x.reshape(-1)
        order = np.argsort(ind, kind="stable")
        there = ind[order]
        starts = np.flatnonzero(np.append(True, there[1:] != there[:-1]))
        g["e"] = np.zeros_like(self.p["e"])
        g["e"][there[starts]] = np.add.reduceat(np.take(de.reshape(-1, WIDTH), order, axis=0), starts, axis=0)
        p, vo = self.p, g.pop("vo")
        qk = g.pop("qk") * vo.dtype.type(1 / np.sqrt(WIDTH))
        g |= {"q": qk @ p["k"], "k": qk.T @ p["q"], "v": vo @ p["o"].T, "o": p["v"].T @ vo}
        for n, bias in (("u", "bu"), ("w1", "b1"), ("u2", "bu2")):
            g[n], g[bias] = g[n][..., :-1, :], g[n][..., -1, :]
        return float(loss * scale), {n: g[n] * g[n].dtype.type(scale) for n in p}

    def _block(self, tables: tuple, turned: tuple, x: np.ndarray, y: np.ndarray, de: np.ndarray) -> tuple[float, dict]:
        """Sums of losses and gradients, those of biases in a last row of the weights they go with; de gets those of inputs."""
        d, (ut, u2t, w2t, w1t, vot, qkt) = WIDTH, turned
        h2, (e, tail, q, both, s, z, h, m) = self.forward(tables, x)
        on, own, place = self.by_group(y)
        read, i = np.take(h2, on, axis=0), np.arange(len(on))
        got, _, outer, total, inner, within, parts = self.heads(tables, read, own, place)
        for w, t, at in ((outer, total, own), (inner, within, place)):
            w *= (1 / t)[:, None]
            w.reshape(-1)[i * w.shape[1] + at] -= 1
        g = {"u": read.T @ outer, "u2": np.zeros((self.groups, d + 1, self.members), e.dtype)}
        back, more = np.zeros((len(on) + 1, d), e.dtype), np.empty((len(on), d), e.dtype)  # the last row: of no target
        np.matmul(outer, ut, out=back[:-1])
        for k, rows in parts:
            np.dot(read[rows].T, inner[rows], out=g["u2"][k])
            np.dot(inner[rows], u2t[k], out=more[rows])
        back[:-1] += more
        turn = np.full(len(h2), len(on))
        turn[on] = i
        dh = np.take(back, turn, axis=0)
        g["w2"] = m.T @ dh
        dm = dh @ w2t
        dm *= m > 0
        g["w1"] = h.T @ dm
        dh += dm @ w1t
        g["vo"] = z.T @ dh
        right = np.empty((len(x), 2 * SCORED, d + 1), e.dtype)
        np.multiply(q, q.dtype.type(np.log(2)), out=right[:, :SCORED, :d])
        dz = right[:, SCORED:]  # over the sums of weights; the last column: what they all lose
        dc = dh @ vot
        lost = (dc * z) @ np.ones(d, e.dtype)
        dc /= s
        lost /= -s[:, 0]
        dz[:, :, :d], dz[:, :, d] = dc.reshape(q.shape), lost.reshape(len(x), SCORED)
        ds = np.matmul(dz, e.transpose(0, 2, 1), out=both[:, :SCORED])
        ds *= both[:, SCORED:]
        dq = (ds @ e[:, :, :d]).reshape(-1, d)
        g["qk"] = tail.T @ dq
        np.matmul(both.transpose(0, 2, 1), right[:, :, :d], out=de)
        dh += dq @ qkt
        de[:, OVERLAP:] += dh.reshape(q.shape)
        return -float(got.sum()) * float(np.log(2)), g

    def state(self) -> np.ndarray:
        """Parameters and Adam's moments as one row."""
        return np.concatenate([self.row(part) for part in (self.p, self.first, self.second)]).astype(np.float32)

    def row(self, part: dict) -> np.ndarray:
        return np.concatenate([part[n].ravel() for n in self.p])

    def load(self, state: np.ndarray, copy: bool = True) -> Attention:
        at = 0
        for part in (self.p, self.first, self.second):
            for n, w in part.items():
                part[n] = state[at : at + w.size].reshape(w.shape)
                part[n] = part[n].copy() if copy else part[n]
                at += w.size
        return self

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 11, turn: int = 0, turns: int = 1, batch: int = BATCH) -> float:
        """Adam over batches of windows in random order, each window as often as any other, give or take one; the last
        losses' mean. No windows: the model stays as it was. These steps are number `turn` of `turns` equal parts."""
        if not len(x):
            return 0.0
        one_thread()
        r, losses = np.random.default_rng(seed), []
        order = np.concatenate([r.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
        state = self.state().reshape(3, -1)
        w, first, second = state
        self.load(state.ravel(), copy=False)  # views of it
        for s in range(turn * steps + 1, (turn + 1) * steps + 1):
            i = order[(s - turn * steps - 1) * batch :][:batch]
            loss, g = self.gradients(x[i], y[i])
            losses.append(loss)
            g, rate = self.row(g), RATE * min(1, s / 50) * (1 - 0.95 * s / (turns * steps))
            first *= 0.9
            first += np.float32(0.1) * g
            second *= 0.99
            g *= g
            g *= 0.01
            second += g
            np.sqrt(second * np.float32(1 / (1 - 0.99**s)), out=g)
            g += 1e-8
            np.divide(first, g, out=g)
            g *= rate / (1 - 0.9**s)
            w -= g
        return float(np.mean(losses[-50:]))
