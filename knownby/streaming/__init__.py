"""Intentionally empty: every operator consumes a finite table.

Late information is modelled bitemporally (a row known after the cutoff is REJECTED and
can never change an earlier replay), so no watermark or stateful stream is involved.
"""
