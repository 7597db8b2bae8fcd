"""Settings from the environment, and the log with suppressed messages."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    """Values of the environment by upper-case field name; a ``.env`` file fills what it lacks."""

    input_folder_path: str = ""
    output_filename: str = "extraction"
    output_folder: str = "output"
    status_table: str = "output/status"
    tokenizer_ranks: str = ""
    ocr_base_url: str = ""
    batch_size: int = 200

    @classmethod
    def load(cls, env_file: str | None = None, environ: dict[str, str] | None = None) -> Settings:
        values = dict(_read_env(env_file)) if env_file and Path(env_file).exists() else {}
        values |= os.environ if environ is None else environ
        found = {f.name: values[f.name.upper()] for f in fields(cls) if f.name.upper() in values}
        return cls(**{k: int(v) if k == "batch_size" else v for k, v in found.items()})


def _read_env(path: str):
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, sep, value = line.strip().partition("=")
        if sep and not name.startswith("#"):
            yield name.strip(), value.strip().strip("'\"")


class Suppress(logging.Filter):
    """Drops records whose logger name and message both contain a rule's strings."""

    def __init__(self, rules: list[tuple[str, str]]):
        super().__init__()
        self.rules = rules

    def filter(self, record: logging.LogRecord) -> bool:
        message = record.getMessage()
        return not any(name in record.name and text in message for name, text in self.rules)


def create_logger(name: str, folder: str, level: int = logging.INFO, rules: list[tuple[str, str]] = ()) -> tuple[logging.Logger, logging.Logger]:
    """A logger to file and console with suppression, and one for errors with a file of its own."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    form = logging.Formatter("%(asctime)s - %(name)s - %(levelname)s - %(message)s")
    out = []
    for label, lowest, quiet in ((name, level, True), (f"{name}_error", logging.ERROR, False)):
        logger = logging.getLogger(label)
        logger.setLevel(lowest)
        logger.handlers.clear()
        for handler in (logging.FileHandler(Path(folder, f"{label}.log"), encoding="utf-8"), *([logging.StreamHandler()] if quiet else [])):
            handler.setFormatter(form)
            if quiet:
                handler.addFilter(Suppress(list(rules)))
            logger.addHandler(handler)
        out.append(logger)
    return out[0], out[1]
