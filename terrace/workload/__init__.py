"""The operators and pipelines run over a star schema, with the SQL each must agree with."""
