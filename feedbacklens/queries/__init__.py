"""Registered queries, by area."""

from . import graphs, preparation, scoring, texts

MODULES = [preparation, texts, graphs, scoring]
