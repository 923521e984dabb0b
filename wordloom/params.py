"""Job parameters, checked on the driver before any Spark job starts."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace

# The four reserved tokens, their roles and their ids.
SPECIALS = {"pad": "<PAD>", "unk": "<UNK>", "sos": "<SOS>", "eos": "<EOS>"}
PAD_ID, UNK_ID, SOS_ID, EOS_ID = 0, 1, 2, 3
FIRST_WORD_ID = 4


@dataclass(frozen=True)
class Encoding:
    """How text becomes tokens and which tokens enter the vocabulary."""

    # Field names and defaults of the stored configuration.
    name: str = "default"
    min_frequency: int = 5
    max_vocab_size: int | None = None
    lowercase: bool = True
    special_tokens: dict = field(default_factory=lambda: dict(SPECIALS))
    token_pattern: str = r"([^\w\s\-])"
    keep_punctuation: tuple = (".", ",", "!", "?", ";", ":")
    strip_accents: bool = False
    unk_threshold: float = 0.15
    dataset_source: str | None = None
    dataset_name: str | None = None
    dataset_rows: int = 52000
    seq_length: int = 512

    def check(self) -> list[str]:
        """Raise on values no job can run with; return what is merely unwise."""
        positive = ("min_frequency", "dataset_rows", "seq_length")
        for name in positive:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be above 0, not {getattr(self, name)}")
        absent = sorted(set(SPECIALS) - set(self.special_tokens))
        if absent:
            raise ValueError(f"no token for the roles {absent}")
        names = [self.special_tokens[role] for role in SPECIALS]
        if len(set(names)) != len(names):
            raise ValueError(f"two roles share a token: {names}")
        if not 0.0 <= self.unk_threshold <= 1.0:
            raise ValueError(f"unk_threshold must lie in [0, 1], not {self.unk_threshold}")
        cap = self.max_vocab_size
        # A cap that leaves no room for words would keep nothing sensible: refused.
        if cap is not None and cap <= FIRST_WORD_ID:
            raise ValueError(f"max_vocab_size must exceed {FIRST_WORD_ID}, not {cap}")
        notes = []
        if self.min_frequency > 20:
            notes.append(f"min_frequency {self.min_frequency} drops most words")
        if cap is not None and cap < 1000:
            notes.append(f"max_vocab_size {cap} leaves very few words")
        return notes

    def updated(self, **changes) -> "Encoding":
        """A copy with some fields changed; an unknown field is an error."""
        known = {f.name for f in fields(self)}
        for name in changes:
            if name not in known:
                raise KeyError(f"no such setting: {name}")
        if "keep_punctuation" in changes:
            changes["keep_punctuation"] = tuple(changes["keep_punctuation"])
        return replace(self, **changes)

    def merged(self, posted: dict) -> "Encoding":
        """Stored settings overlaid with posted ones, then checked."""
        merged = Encoding.from_dict({**self.to_dict(), **posted})
        merged.check()
        return merged

    def to_dict(self) -> dict:
        return {**asdict(self), "keep_punctuation": list(self.keep_punctuation)}

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), ensure_ascii=False)

    @staticmethod
    def from_dict(stored: dict) -> "Encoding":
        """Read stored settings; fields this version does not know are ignored."""
        known = {f.name for f in fields(Encoding)}
        kept = {k: v for k, v in stored.items() if k in known}
        if "keep_punctuation" in kept:
            kept["keep_punctuation"] = tuple(kept["keep_punctuation"])
        return Encoding(**kept)

    @staticmethod
    def from_stored(config: dict | None, min_frequency: int | None = None) -> "Encoding":
        """Stored settings if there are any; an old file keeps only its minimum frequency."""
        if config:
            return Encoding.from_dict(config)
        return Encoding() if min_frequency is None else Encoding(min_frequency=min_frequency)


# The three built-in presets.
DEFAULT = Encoding()
CONVERSATIONAL = Encoding(
    name="conversational",
    min_frequency=3,
    token_pattern=r"([^\w\s\-'])",
    keep_punctuation=(".", ",", "!", "?", ";", ":", "'", '"', "-"),
    unk_threshold=0.10,
)
TECHNICAL = Encoding(
    name="technical",
    min_frequency=2,
    lowercase=False,
    token_pattern=r"([^\w\s\-_.])",
    keep_punctuation=(".", ",", "(", ")", "[", "]", "{", "}", "=", "+", "-", "*", "/", ":", ";"),
    strip_accents=True,
    unk_threshold=0.20,
)

_PRESETS: dict[str, Encoding] = {e.name: e for e in (DEFAULT, CONVERSATIONAL, TECHNICAL)}


def register_encoding(name: str, encoding: Encoding) -> None:
    _PRESETS[name] = encoding.updated(name=name)


def get_encoding(name: str) -> Encoding:
    """A preset by name. Presets are frozen, so sharing them is safe."""
    if name not in _PRESETS:
        raise KeyError(f"no encoding called {name!r}; known: {sorted(_PRESETS)}")
    return _PRESETS[name]


def list_encodings() -> list[dict]:
    return [{"name": n, "config": e.to_dict()} for n, e in _PRESETS.items()]


@dataclass(frozen=True)
class TrainingPlan:
    """Sizes and rates that shape samples, batches and the step schedule."""

    # Defaults.
    epochs: int = 50
    batch_size: int = 10
    accum_steps: int = 4
    log_interval: int = 20
    max_lr: float = 5e-4
    min_lr: float = 1e-5
    warmup_steps: int = 500
    label_smoothing: float = 0.2
    grad_clip: float = 1.1
    dropout: float = 0.1
    seq_length: int = 512
    val_split: float = 0.1
    rows: int = 20000
    vocab_rows: int = 52000
    article_rows: int = 50000

    def check(self) -> list[str]:
        for name in ("epochs", "batch_size", "accum_steps", "seq_length", "rows", "max_lr", "grad_clip"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be above 0, not {getattr(self, name)}")
        for name in ("label_smoothing", "dropout"):
            if not 0.0 <= getattr(self, name) < 1.0:
                raise ValueError(f"{name} must lie in [0, 1), not {getattr(self, name)}")
        if not 0.0 < self.val_split < 1.0:
            raise ValueError(f"val_split must lie in (0, 1), not {self.val_split}")
        if self.min_lr < 0:
            raise ValueError(f"min_lr must not be negative, not {self.min_lr}")
        if self.min_lr >= self.max_lr:
            return [f"min_lr {self.min_lr} is not below max_lr {self.max_lr}: the decay is flat"]
        return []


def require_rows(df, what: str) -> None:
    """Stop the job when a stage has produced nothing (reads one row at most)."""
    if df.isEmpty():
        raise ValueError(f"no {what}: check the source and the parameters")
