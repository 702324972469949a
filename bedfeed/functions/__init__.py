"""Column expressions: HL7 text, times, values, locations, text cleaning, waveform maths."""
