"""Pluggable models: registries of embedding and labelling backends."""

from __future__ import annotations

from dataclasses import fields


class BackendError(Exception):
    """A reply could not be had; ``reason`` becomes the error label."""

    def __init__(self, reason: str):
        super().__init__(reason)
        self.reason = reason


def make_backend(registry: dict[str, type], name: str, **options):
    """An instance by name; unknown names raise, options that the class lacks are dropped."""
    if name not in registry:
        raise ValueError(f"unknown backend {name!r}; known are {sorted(registry)}")
    own = {f.name for f in fields(registry[name]) if f.init}
    return registry[name](**{k: v for k, v in options.items() if k in own})
