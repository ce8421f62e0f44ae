"""Sources and sinks: tables (S01/S02), messages (S05/S06/S08/S09/S12) and
candle views derived from the driver's test tables."""
