"""Query keys -> (Spark job, SQL twin or None). ``__spark_entry__`` reads this."""

from __future__ import annotations

from canvass.plans import contact_jobs as cj
from canvass.plans import dialogue_jobs as dj
from canvass.plans import email_upload as eu
from canvass.plans import event_jobs as ej
from canvass.plans import export_jobs as xj
from canvass.plans import geo_jobs
from canvass.plans import lookup_jobs as lj
from canvass.plans import outreach_exports as ox
from canvass.plans.more_jobs import MORE
from canvass.plans.push_jobs import PUSH
from canvass.plans import sms_upload as su
from canvass.plans import stream_jobs as st
from canvass.plans import sync_jobs as sj

REGISTRY = {
    "nearest_poi": (geo_jobs.nearest_poi, geo_jobs.NEAREST_POI_SQL),
    "nearest_by_phase_tolerance": (geo_jobs.nearest_by_phase_tolerance,
                                   geo_jobs.NEAREST_BY_PHASE_TOLERANCE_SQL),
    "phase_asof": (geo_jobs.phase_asof, geo_jobs.PHASE_ASOF_SQL),
    "radius_events": (geo_jobs.radius_events, geo_jobs.RADIUS_EVENTS_SQL),
    "email_upload": (eu.email_upload, eu.EMAIL_UPLOAD_SQL),
    "email_upload_limited": (eu.email_upload_limited, eu.EMAIL_UPLOAD_LIMITED_SQL),
    "email_upload_records": (eu.email_upload_records, eu.EMAIL_UPLOAD_RECORDS_SQL),
    "event_lookup": (lj.event_lookup, lj.EVENT_LOOKUP_SQL),
    "sms_upload": (su.sms_upload, su.SMS_UPLOAD_SQL),
    "merge_contacts": (cj.merge_contacts, cj.MERGE_CONTACTS_SQL),
    "first_touch": (cj.first_touch, cj.FIRST_TOUCH_SQL),
    "latest_per_key": (cj.latest_per_key, cj.LATEST_PER_KEY_SQL),
    "best_record": (cj.best_record, cj.BEST_RECORD_SQL),
    "last_action_type": (cj.last_action_type, cj.LAST_ACTION_TYPE_SQL),
    "bulk_loaders": (cj.bulk_loaders, cj.BULK_LOADERS_SQL),
    "precinct_scores": (cj.precinct_scores, cj.PRECINCT_SCORES_SQL),
    "membership_flags": (cj.membership_flags, cj.MEMBERSHIP_FLAGS_SQL),
    "target_universe": (cj.target_universe, cj.TARGET_UNIVERSE_SQL),
    "anti_subscribed": (cj.anti_subscribed, cj.ANTI_SUBSCRIBED_SQL),
    "suppress_by_region": (cj.suppress_by_region, cj.SUPPRESS_BY_REGION_SQL),
    "semi_recent": (cj.semi_recent, cj.SEMI_RECENT_SQL),
    "phone_class": (cj.phone_class, cj.PHONE_CLASS_SQL),
    "canonical_identity": (cj.canonical_identity, cj.CANONICAL_IDENTITY_SQL),
    "identity_match": (cj.identity_match, cj.IDENTITY_MATCH_SQL),
    "union_feeds": (cj.union_feeds_q, cj.UNION_FEEDS_SQL),
    "distinct_union": (cj.distinct_union, cj.DISTINCT_UNION_SQL),
    "resubscribe_filter": (sj.resubscribe_filter, sj.RESUBSCRIBE_FILTER_SQL),
    "pivot_fields": (sj.pivot_fields, sj.PIVOT_FIELDS_SQL),
    "field_diff_crm": (sj.field_diff_crm, sj.FIELD_DIFF_CRM_SQL),
    "field_diff_sms": (sj.field_diff_sms, sj.FIELD_DIFF_SMS_SQL),
    "time_buckets": (sj.time_buckets, sj.TIME_BUCKETS_SQL),
    "group_members": (sj.group_members, sj.GROUP_MEMBERS_SQL),
    "membership_delta": (sj.membership_delta, sj.MEMBERSHIP_DELTA_SQL),
    "new_groups": (sj.new_groups, sj.NEW_GROUPS_SQL),
    "cap_per_type": (sj.cap_per_type, sj.CAP_PER_TYPE_SQL),
    "batches": (sj.batches, sj.BATCHES_SQL),
    "counts_by": (sj.counts_by, sj.COUNTS_BY_SQL),
    "donor_rollup": (ej.donor_rollup, ej.DONOR_ROLLUP_SQL),
    "drop_stale": (ej.drop_stale, ej.DROP_STALE_SQL),
    "recent_nyc": (ej.recent_nyc, ej.RECENT_NYC_SQL),
    "send_hours": (ej.send_hours, ej.SEND_HOURS_SQL),
    "lag_gate": (ej.lag_gate, ej.LAG_GATE_SQL),
    "local_time": (ej.local_time, ej.LOCAL_TIME_SQL),
    "latest_kv": (ej.latest_kv, ej.LATEST_KV_SQL),
    "extract_contacts": (ej.extract_contacts, ej.EXTRACT_CONTACTS_SQL),
    "inbound_text": (ej.inbound_text, ej.INBOUND_TEXT_SQL),
    "json_props": (ej.json_props, ej.JSON_PROPS_SQL),
    "utm_links": (ej.utm_links, ej.UTM_LINKS_SQL),
    "invite_buttons": (ej.invite_buttons, ej.INVITE_BUTTONS_SQL),
    "debt_relief": (ej.debt_relief, ej.DEBT_RELIEF_SQL),
    "donor_stream": (st.donor_stream, st.DONOR_STREAM_SQL),
    "lag_windows": (st.lag_windows, st.LAG_WINDOWS_SQL),
    "new_subscribers": (st.new_subscribers, st.NEW_SUBSCRIBERS_SQL),
    "cancellation_keys": (st.cancellation_keys, st.CANCELLATION_KEYS_SQL),
    "event_signups": (xj.event_signups, xj.EVENT_SIGNUPS_SQL),
    "invite_export": (xj.invite_export, xj.INVITE_EXPORT_SQL),
    "config_groups": (xj.config_groups, xj.CONFIG_GROUPS_SQL),
    "email_validation": (xj.email_validation, xj.EMAIL_VALIDATION_SQL),
    "donor_lookup": (xj.donor_lookup, xj.DONOR_LOOKUP_SQL),
    "merge_props": (xj.merge_props, xj.MERGE_PROPS_SQL),
    "day_matched": (xj.day_matched, xj.DAY_MATCHED_SQL),
    "sms_optin_export": (ox.sms_optin_export, ox.SMS_OPTIN_EXPORT_SQL),
    "email_export": (ox.email_export, ox.EMAIL_EXPORT_SQL),
    "email_export_capped": (ox.email_export_capped, ox.EMAIL_EXPORT_CAPPED_SQL),
    "result_report": (ej.result_report, ej.RESULT_REPORT_SQL),
    "dialogue_replay": (dj.dialogue_replay, dj.DIALOGUE_REPLAY_SQL),
    # Scripted conversations: the twin states the script's expected outcome.
    "referrals": (ej.referrals, ej.REFERRALS_SQL),
    **MORE, **PUSH,
}
