"""DataFrame to DataFrame operators.

Every operator takes its column names as parameters and an optional ``series`` key. Without a
key all months form one series. Windows are only ever laid over months (or days) that were
aggregated first, so a window partition holds calendar-many rows, however many records a
series has.
"""
