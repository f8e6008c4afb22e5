"""A gated recurrent language model in numpy with a class-factored softmax."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

HIDDEN = 16
# Words of a class. Word numbers go by frequency, so a class holds words of like frequency.
CLASS_WORDS = 64
# Steps between truncations of the gradient while fitting.
FIT_STEPS = 24
# A window of scoring ends once this many states are gathered, which bounds its memory.
WINDOW_STATES = 1 << 15
# Parallel streams that a text is fitted in: one per so many words, within these bounds.
STREAM_WORDS = 1 << 11
STREAMS, MOST_STREAMS = 64, 512
EPOCHS = 3
RATE = 0.02
# Logits are worked through in pieces of so many rows, which stay in the processor's cache.
PIECE_ROWS = 1 << 12
# Up to this difference between bounds of the largest logit a sum of powers cannot vanish.
_SAFE = 60.0


class Model(NamedTuple):
    """Weights; ``inputs`` holds each word's share of the three gates before activation."""

    inputs: np.ndarray  # words x 3 HIDDEN
    recurrent: np.ndarray  # HIDDEN x 3 HIDDEN
    recurrent_bias: np.ndarray  # 3 HIDDEN
    class_weight: np.ndarray  # HIDDEN x classes
    class_bias: np.ndarray  # classes
    word_weight: np.ndarray  # classes x HIDDEN x CLASS_WORDS
    word_bias: np.ndarray  # classes x CLASS_WORDS


def start_model(counts: np.ndarray, seed: int = 5) -> Model:
    """Weights whose first guesses are the frequencies of the words; no word is impossible."""
    rng = np.random.default_rng(seed)
    words = len(counts)
    classes = -(-words // CLASS_WORDS)
    share = np.zeros(classes * CLASS_WORDS)
    share[:words] = (counts + 0.5) / (counts.sum() + 0.5 * words)
    share = share.reshape(classes, CLASS_WORDS)
    with np.errstate(divide="ignore"):
        word_bias = np.maximum(np.log(share / share.sum(axis=1, keepdims=True)), -1e4)
    return Model(
        rng.normal(0, 0.3, (words, 3 * HIDDEN)).astype(np.float32),
        rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        np.zeros(3 * HIDDEN, np.float32),
        np.zeros((HIDDEN, classes), np.float32),
        np.log(share.sum(axis=1)).astype(np.float32),
        np.zeros((classes, HIDDEN, CLASS_WORDS), np.float32),
        word_bias.astype(np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def step(model: Model, state: np.ndarray, word: np.ndarray):
    """(next state, reset, update, candidate, recurrent share of the candidate)."""
    own = model.inputs[word]
    carried = state @ model.recurrent
    carried += model.recurrent_bias
    gates = _sigmoid(own[:, : 2 * HIDDEN] + carried[:, : 2 * HIDDEN])
    reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
    inner = carried[:, 2 * HIDDEN :]
    candidate = np.tanh(own[:, 2 * HIDDEN :] + reset * inner)
    return candidate + update * (state - candidate), reset, update, candidate, inner


def log_probabilities(model: Model, states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Natural log probability of each word after each state: its class, then it in the class."""
    order, bounds, states, classes, within = _by_class(model, states, words)
    of_class = _shift(model.class_weight, model.class_bias)
    of_word = _shift(model.word_weight, model.word_bias)
    values = np.empty(len(words), np.float32)
    for at in range(0, len(words), PIECE_ROWS):
        here = slice(at, at + PIECE_ROWS)
        logits = states[here] @ model.class_weight
        logits += model.class_bias
        values[here] = logits[np.arange(len(logits)), classes[here]] - _log_sum(logits, of_class)
    for k in np.flatnonzero(np.diff(bounds)):
        for at in range(bounds[k], bounds[k + 1], PIECE_ROWS):
            here = slice(at, min(at + PIECE_ROWS, bounds[k + 1]))
            inner = states[here] @ model.word_weight[k]
            inner += model.word_bias[k]
            values[here] += inner[np.arange(len(inner)), within[here]] - _log_sum(inner, of_word[k])
    out = np.empty_like(values)
    out[order] = values
    return out


def _by_class(model: Model, states: np.ndarray, words: np.ndarray):
    """(order, first row of each class, then in this order: states, classes, places in the class)."""
    classes = (words // CLASS_WORDS).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    bounds = np.searchsorted(classes, np.arange(len(model.class_bias) + 1))
    return order, bounds, states[order], classes, words[order] % CLASS_WORDS


def _shift(weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """A number at least as large as all logits, per class; not a number where logits could lie far below it.

    States lie between -1 and 1, which bounds the logits.
    """
    reach = np.abs(weight).sum(axis=-2)
    top = (bias + reach).max(axis=-1)
    return np.where(top - (bias - reach).max(axis=-1) < _SAFE, top, np.nan).astype(np.float32)


def _log_sum(logits: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The logarithm of the sum of powers; the logits become the powers."""
    top = logits.max(axis=1) if np.isnan(shift) else np.full(len(logits), shift)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return top + np.log(logits.sum(axis=1))


def score_texts(model: Model, words: np.ndarray, offsets: np.ndarray, first: int) -> np.ndarray:
    """Natural log probability of each whole text, given as word numbers.

    All texts run side by side, one word a step; a text keeps its state from window to
    window until its last word. ``first`` is the word number that stands before a text.
    """
    lengths = np.diff(offsets)
    totals = np.zeros(len(lengths))
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], lengths[order]
    alive = int((sizes > 0).sum())
    state = np.zeros((alive, HIDDEN), np.float32)
    before = np.full(alive, first)
    at = 0
    while alive:
        states, targets, owners = [], [], []
        gathered = 0
        while gathered < WINDOW_STATES:
            alive = int(np.searchsorted(-sizes, -at, side="left"))
            if not alive:
                break
            state = step(model, state[:alive], before[:alive])[0]
            before = words[starts[:alive] + at]
            states.append(state)
            targets.append(before)
            owners.append(np.arange(alive))
            gathered += alive
            at += 1
        if states:
            values = log_probabilities(model, np.concatenate(states), np.concatenate(targets))
            totals[order[: len(owners[0])]] += np.bincount(np.concatenate(owners), values, minlength=len(owners[0]))
    return totals


def fit(model: Model, words: np.ndarray, first: int) -> Model:
    """Several passes over one long text, the rate falling from pass to pass."""
    fitting = Fitting(model)
    for epoch in range(EPOCHS):
        fitting.run(words, first, RATE * (1 - epoch / EPOCHS))
    return model


class Fitting:
    """Truncated backpropagation through time; the model's weights change in place."""

    def __init__(self, model: Model):
        self.model = model
        self.sizes = [weights.size for weights in model]
        self.mean, self.square = np.zeros(sum(self.sizes), np.float32), np.zeros(sum(self.sizes), np.float32)
        self.updates = 0

    def run(self, words: np.ndarray, first: int, rate: float) -> None:
        """One pass over a long text, cut into parallel streams; every word is a target once.

        ``first`` is the word number that stands before the text.
        """
        if not len(words):
            return
        words = words.astype(np.int64)
        length = -(-len(words) // min(MOST_STREAMS, max(STREAMS, len(words) // STREAM_WORDS)))
        width = -(-len(words) // length)
        # The last stream may be shorter than the others.
        last = len(words) - (width - 1) * length
        inputs = np.concatenate(([first], words[:-1]))
        starts = np.arange(width) * length
        state = np.zeros((width, HIDDEN), np.float32)
        at = 0
        while at < length:
            alive = width if at < last else width - 1
            steps = min(FIT_STEPS, (last if at < last else length) - at)
            places = starts[:alive] + np.arange(at, at + steps)[:, None]
            gradients, state = _window_gradients(self.model, state[:alive], inputs[places], words[places])
            self._update(np.concatenate([g.ravel() for g in gradients]), rate)
            at += steps

    def _update(self, gradient: np.ndarray, rate: float) -> None:
        self.updates += 1
        gradient *= np.float32(min(1.0, 1.0 / max(float(np.sqrt(gradient @ gradient)), 1e-9)))
        self.mean += np.float32(0.1) * (gradient - self.mean)
        gradient *= gradient
        gradient -= self.square
        gradient *= np.float32(0.002)
        self.square += gradient
        change = self.square * np.float32(1 / (1 - 0.998**self.updates))
        np.sqrt(change, out=change)
        change += np.float32(1e-6)
        np.divide(self.mean, change, out=change)
        change *= np.float32(rate / (1 - 0.9**self.updates))
        for weights, own in zip(self.model, np.split(change, np.cumsum(self.sizes)[:-1]), strict=True):
            weights -= own.reshape(weights.shape)


def _window_gradients(model: Model, state: np.ndarray, inputs: np.ndarray, targets: np.ndarray):
    """Mean gradients over a window of steps, and the state after it."""
    kept = []
    for word in inputs:
        following, *parts = step(model, state, word)
        kept.append((state, *parts))
        state = following
    after = np.stack([*(k[0] for k in kept[1:]), state]).reshape(-1, HIDDEN)
    to_states, out = _output_gradients(model, after, targets.reshape(-1))
    to_states = to_states.reshape(len(inputs), -1, HIDDEN)
    to_recurrent = np.zeros_like(model.recurrent)
    to_bias = np.zeros_like(model.recurrent_bias)
    owns = np.empty((*inputs.shape, 3 * HIDDEN), np.float32)
    flow = np.zeros_like(state)
    for k in range(len(inputs) - 1, -1, -1):
        old, reset, update, candidate, inner = kept[k]
        flow = flow + to_states[k]
        at_candidate = flow * (1 - update) * (1 - candidate * candidate)
        at_update = flow * (old - candidate) * update * (1 - update)
        at_reset = at_candidate * inner * reset * (1 - reset)
        owns[k] = np.concatenate((at_reset, at_update, at_candidate), axis=1)
        carried = np.concatenate((at_reset, at_update, at_candidate * reset), axis=1)
        to_recurrent += old.T @ carried
        to_bias += carried.sum(axis=0)
        flow = flow * update + carried @ model.recurrent.T
    to_inputs = np.zeros_like(model.inputs)
    given = inputs.reshape(-1)
    order = np.argsort(given, kind="stable")
    found, begins = np.unique(given[order], return_index=True)
    to_inputs[found] = np.add.reduceat(owns.reshape(-1, 3 * HIDDEN)[order], begins, axis=0)
    return (to_inputs, to_recurrent, to_bias, *out), state


def _output_gradients(model: Model, states: np.ndarray, words: np.ndarray):
    share = np.float32(1 / len(words))
    order, bounds, states, classes, within = _by_class(model, states, words)
    of_class = _shift(model.class_weight, model.class_bias)
    of_word = _shift(model.word_weight, model.word_bias)
    sorted_gradients = np.empty_like(states)
    to_class_weight, to_class_bias = np.zeros_like(model.class_weight), np.zeros_like(model.class_bias)
    for at in range(0, len(words), PIECE_ROWS):
        here = slice(at, at + PIECE_ROWS)
        error = _errors(states[here] @ model.class_weight + model.class_bias, classes[here], of_class, share)
        sorted_gradients[here] = error @ model.class_weight.T
        to_class_weight += states[here].T @ error
        to_class_bias += error.sum(axis=0)
    to_word_weight = np.zeros_like(model.word_weight)
    to_word_bias = np.zeros_like(model.word_bias)
    for k in np.flatnonzero(np.diff(bounds)):
        here = slice(bounds[k], bounds[k + 1])
        error = _errors(states[here] @ model.word_weight[k] + model.word_bias[k], within[here], of_word[k], share)
        to_word_weight[k] = states[here].T @ error
        to_word_bias[k] = error.sum(axis=0)
        sorted_gradients[here] += error @ model.word_weight[k].T
    to_states = np.empty_like(states)
    to_states[order] = sorted_gradients
    return to_states, (to_class_weight, to_class_bias, to_word_weight, to_word_bias)


def _errors(logits: np.ndarray, targets: np.ndarray, shift: np.ndarray, share: np.float32) -> np.ndarray:
    """Gradients of the logits: probabilities less one at the target, times ``share``."""
    logits -= logits.max(axis=1, keepdims=True) if np.isnan(shift) else shift
    np.exp(logits, out=logits)
    logits *= (share / logits.sum(axis=1))[:, None]
    logits[np.arange(len(logits)), targets] -= share
    return logits
