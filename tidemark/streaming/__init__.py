"""The toolkit is batch only: daily tables are rebuilt, nothing is consumed as a stream."""
