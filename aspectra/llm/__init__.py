"""Training-data operators: deduplication, scans, tokenisation, filters, packing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Operators take and
return DataFrames.  Functions that run in Python workers are pickled by reference, so the
package must be installed (or on PYTHONPATH) on the executors.
"""
