"""Sources: HL7 folders, observation tables, patient state."""
