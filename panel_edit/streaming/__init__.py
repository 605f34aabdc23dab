"""Streaming: intentionally empty.

The editing engine reproduces a batch workflow - read a panel, flag, let an
analyst review, adjust, map - with a human between stages. It has no
streams, watermarks, event-time windows or state, so no Structured Streaming
operator is provided; the batch jobs in :mod:`panel_edit.plans.jobs` read
whatever files a stream would have landed.
"""
