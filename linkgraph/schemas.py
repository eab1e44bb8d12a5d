"""Schemas of the tables that stages exchange. Absent text is '', absent numbers and dates are null."""

from __future__ import annotations

RECORD = (
    "record_id string, source string, entity_type string, name string, name_norm string, name_fp string, name_phonetic string, first_name string, middle_name string, last_name string, birth_year int, birth_month int, nationality string, country string, "
    "jurisdiction string, reg_number string, address_full string, address_norm string, postcode string, address_blk string, incorporation_date date, dissolution_date date, status string, legal_form string, sic_codes array<string>, topics array<string>, "
    "datasets array<string>, context_company_number string, source_url string, retrieved_at string"
)
RELATIONSHIP = (
    "rel_id string, rel_type string, source_record_id string, target_record_id string, source string, min_percent double, max_percent double, control_kinds array<string>, capacities array<string>, has_hard_control boolean, via_fiduciary boolean, "
    "notified_on date, ceased_on date"
)
FILING = (
    "company_number string, data struct<kind:string, name:string, name_elements:struct<title:string, forename:string, middle_name:string, surname:string>, address:struct<care_of:string, po_box:string, premises:string, address_line_1:string, address_line_2:string, "
    "locality:string, region:string, postal_code:string, country:string>, date_of_birth:struct<month:int, year:int>, nationality:string, country_of_residence:string, identification:struct<registration_number:string, country_registered:string, "
    "place_registered:string, legal_form:string, legal_authority:string>, natures_of_control:array<string>, notified_on:string, ceased_on:string, links:struct<self:string>, statement:string, description:string>"
)
SANCTIONED = "id string, caption string, schema string, properties map<string, array<string>>, datasets array<string>, referents array<string>"
