"""Messages that several tests read; all names, times and places are invented."""

WAVE = "\n".join([
    "MSH|^~\\&|BEDSIDE|WARD|||20310907081500.250-0400||ORU^R01|C1|P|2.5|||||||||PROF^V~OTHER",
    "PID|1||R7701^^^A^MR||ROWAN^ALMA|||||||||||||V1",
    "PV1|1|I|NORTH-4TN-K718",
    "OBR|1|||69121^MDC_OBS_WAVE_CTS^MDC|||20310907081500.000-0400|20310907081500.006-0401||NORTH-4TN-K718|||E1||||||||DEV",
    "OBX|1|NA|1^MDC_ECG_ELEC_POTL_I^MDC|1.0|1^2^x|4^mV^U|0-1|||||||20310907081500.000-0400|||||||77",
    "OBX|2|NM|2^MDC_ATTR_TIME_PD_SAMP^MDC|1.1|2.0|ms||||||||20310907081500.000-0400",
])
ADT = "MSH|^~\\&|ADM|WARD|||20310907061000-0400||ADT^A01|A1|P|2.4\rEVN|A01\rPID|1||I||No Record\rPV1|1|I|G5ICU^G505"
