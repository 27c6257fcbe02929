"""The library's checks over the given tables: derived inputs, registered queries, their SQL twins."""
