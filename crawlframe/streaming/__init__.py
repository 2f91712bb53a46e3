"""Structured Streaming jobs over streams of fetched pages and of requests.

Every job ends when its input is drained (``availableNow``) and goes on from its checkpoint when
started again. Politeness keeps its hosts in the stream's own keyed state. The other jobs run batch by
batch: writers replace their own ``batch_id=N`` directory, and what earlier batches left is a keyed table
of which batch ``N`` reads the last version before ``N``, so a batch that runs twice gives the same rows.
"""
