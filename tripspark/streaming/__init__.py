"""The daily load as a stream over the bronze folder."""
