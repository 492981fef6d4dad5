"""Table-corpus engine: raw delimited files in, profiled and annotated tables out."""

__version__ = "0.1.0"
