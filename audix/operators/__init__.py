"""The reference's operators re-expressed as DataFrame programs."""
