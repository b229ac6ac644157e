"""Plan-level helpers: size-checked broadcasts, shared scratch storage and the
query registry used by ``__spark_entry__.py``."""
