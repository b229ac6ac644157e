"""Pure ``DataFrame -> DataFrame`` operators; each works on batch and, where the
semantics allow, streaming DataFrames."""
