"""Logging of a run: to the console and, if asked, to a file that rolls over."""

from __future__ import annotations

import json
import logging
from logging.handlers import RotatingFileHandler
from pathlib import Path

_ROOT = "millrace"
_UNITS = {"KB": 1 << 10, "MB": 1 << 20, "GB": 1 << 30}


class _Json(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"time": self.formatTime(record), "level": record.levelname, "name": record.name, "message": record.getMessage()})


def size_of(text: str) -> int:
    """Bytes of a size such as ``10 MB``."""
    number, unit = text.split()
    return int(float(number) * _UNITS[unit.upper()])


def configure_logging(folder: str | None = None, *, level: str = "INFO", file_name: str = "pipeline.log", rotation: str = "10 MB", keep: int = 5, as_json: bool = False) -> logging.Logger:
    """Set the handlers of all ``millrace`` loggers anew."""
    root = logging.getLogger(_ROOT)
    for handler in list(root.handlers):
        root.removeHandler(handler)
        handler.close()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if folder:
        Path(folder).mkdir(parents=True, exist_ok=True)
        handlers.append(RotatingFileHandler(Path(folder) / file_name, maxBytes=size_of(rotation), backupCount=keep, encoding="utf-8"))
    for handler in handlers:
        handler.setFormatter(_Json() if as_json else logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        root.addHandler(handler)
    root.setLevel(level)
    return root


def get_logger(name: str) -> logging.Logger:
    return logging.getLogger(f"{_ROOT}.{name}")
