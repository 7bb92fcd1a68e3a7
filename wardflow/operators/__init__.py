"""The document and message jobs: HL7, C-CDA, FHIR and terminology."""
