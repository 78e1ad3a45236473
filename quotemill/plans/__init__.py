"""Job composition (J1, J2) and plan inspection."""
