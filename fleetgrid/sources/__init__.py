"""Reading, decoding and writing pings, riders, state and reports."""
