"""The registered queries restated in plain SQL for the checking engine.

The text templates' structures are listed here by template number, so these statements need none of the
patterns the library uses; replies are listed by form in the same way.
"""

from __future__ import annotations

from replat.operators.counts import COUNT_FIELDS
from replat.plans import adapters

MODEL = "model-1"
STAMP = "2026-01-01T00:00:00+00:00"

_PARCELS = adapters.PARCELS.format(customer="customer")
_CASES = adapters.CASES.format(
    days="datediff('day', date '1970-01-01', cast(o_orderdate as date))", orders="orders"
)
_REGIONS = adapters.REGIONS.format(nation="nation")
_SUBREGIONS = adapters.SUBREGIONS.format(nation="nation").replace(
    "explode(array(0, 1, 2, 3))", "unnest([0, 1, 2, 3])"
)
_REPLIES = adapters.REPLIES.format(customer="customer")

_CTES = {
    "parcels": _PARCELS,
    "cases": _CASES,
    "regions": _REGIONS,
    "subregions": _SUBREGIONS,
    "replies": _REPLIES,
    # structures named by each text template, with the source of the area
    "template_structures": """
  select * from (values
    (0, 0, 'sfr', 'z'), (1, 0, 'sfr', 'z'), (2, 0, 'sfr', 'z'), (2, 1, 'adu', 'z2'), (3, 0, 'sfr', 'z'),
    (4, 0, 'mfr', 'z'), (5, 0, 'sfr', 'z'), (6, 0, 'temporary_housing', null), (7, 0, 'repair', 'z'),
    (8, 0, 'unknown', null), (9, 0, 'unknown', null), (9, 1, 'jadu', 'z2'), (9, 2, 'garage', null),
    (11, 0, 'adu', 'z2'), (11, 1, 'adu', 'z2'), (12, 0, 'adu', 'z2'), (12, 1, 'adu', 'z2'), (12, 2, 'adu', '640'),
    (14, 0, 'adu', 'z2'), (15, 0, 'seismic', null), (16, 0, 'garage', 'z2'), (17, 0, 'mfr', '1,z2'),
    (17, 1, 'temporary_housing', null), (18, 0, 'jadu', 'z2'), (19, 0, 'sfr', 'z')
  ) t(tpl, seg_idx, struct_type, area)""",
    "structures": """
  select c.seq, c.main_ain, t.seg_idx, t.struct_type,
    regexp_replace(trim(string_split(replace(c.description, chr(13), ''), chr(10))[t.seg_idx + 1]), '^[0-9]+[.] ', '') as raw_segment,
    case t.area when 'z' then cast(c.sz as double) when 'z2' then cast(c.sz2 as double) when '640' then 640.0
      when '1,z2' then 1000.0 + cast(c.sz2 as double) end as sqft
  from cases c join template_structures t on c.tpl = t.tpl""",
    "parsed": """
  select seq,
    count(*) filter (where struct_type = 'sfr') as sfr_count, sum(sqft) filter (where struct_type = 'sfr') as sfr_sqft,
    count(*) filter (where struct_type = 'adu') as adu_count, sum(sqft) filter (where struct_type = 'adu') as adu_sqft,
    count(*) filter (where struct_type = 'mfr') as mfr_count, sum(sqft) filter (where struct_type = 'mfr') as mfr_sqft,
    bool_or(struct_type <> 'unknown' or sqft is not null) as any_parsed,
    bool_and(struct_type = 'unknown') as all_unknown
  from structures group by seq""",
    "facts": """
  select c.*, coalesce(c.disaster_type = 'Eaton Fire (01-2025)', false) or c.tpl in (0, 1, 6, 8, 19) as is_event,
    c.modulename = 'PermitManagement' as is_permit,
    c.modulename = 'PermitManagement' and c.workclass_name in ('New', 'Rebuild Project') as is_primary,
    c.modulename = 'PermitManagement' and c.workclass_name in ('New', 'Rebuild Project')
      or c.modulename = 'PlanManagement' and c.workclass_name = 'Rebuild' as is_qualifying,
    case c.tpl when 1 then true when 4 then false end as desc_signal,
    case c.seq % 5 when 0 then true when 1 then false end as name_signal,
    c.tpl in (3, 19) or c.seq % 5 = 2 or c.seq % 31 = 0 as mentions_pathway,
    coalesce(p.sfr_count, 0) as sfr_count, p.sfr_sqft, coalesce(p.adu_count, 0) as adu_count, p.adu_sqft,
    coalesce(p.mfr_count, 0) as mfr_count, p.mfr_sqft,
    coalesce(p.any_parsed, false) as any_parsed, coalesce(p.all_unknown, false) as all_unknown
  from cases c left join parsed p on c.seq = p.seq""",
    "primaries": """
  select * from (select *, row_number() over (partition by main_ain
      order by coalesce(rebuild_progress_num, 0) desc, seq) as rn
    from facts where is_event and is_primary) where rn = 1""",
    "claims": """
  select main_ain, claim from (select main_ain, coalesce(desc_signal, name_signal) as claim,
      row_number() over (partition by main_ain order by coalesce(apply_date, 0) desc, seq) as rn
    from facts where is_event and coalesce(desc_signal, name_signal) is not null) where rn = 1""",
    "unit_permits": """
  select main_ain, all_unknown from (select main_ain, all_unknown,
      row_number() over (partition by main_ain order by seq) as rn
    from facts where is_permit and new_dwelling_units > 0) where rn = 1""",
    "rollup": """
  select f.main_ain, count(*) as case_count, max(rebuild_progress_num) filter (where is_event) as max_progress,
    coalesce(bool_or(desc_signal or name_signal) filter (where is_event), false)
      and coalesce(bool_or(not desc_signal or not name_signal) filter (where is_event), false) as claim_conflict,
    bool_or(is_event and mentions_pathway) as mentions_pathway,
    bool_or(is_event and is_qualifying) as has_qualifying,
    bool_or(is_event and is_qualifying and is_permit) as has_qualifying_permit,
    count(*) filter (where is_event and is_permit and length(description) > 0) as parse_candidates,
    count(*) filter (where is_event and is_permit and length(description) > 0 and any_parsed) as parse_hits,
    count(*) filter (where is_permit and tpl in (0, 1, 2, 5, 14)) as area_candidates,
    count(*) filter (where is_permit and tpl in (0, 1, 2, 5)) as area_hits
  from facts f group by f.main_ain""",
    "slots": """
  select *, substr(designtype1, 1, 2) as f1, substr(designtype2, 1, 2) as f2, usedescription = 'Single' as single
  from parcels""",
    "pre": """
  select seq,
    cast(coalesce(f1 = '01', false) as int) + cast(coalesce(f2 = '01' and not single, false) as int) as sfr_count,
    case when f1 = '01' or f2 = '01' and not single then coalesce(case when f1 = '01' then sqftmain1 end, 0)
      + coalesce(case when f2 = '01' and not single then sqftmain2 end, 0) end as sfr_sqft,
    cast(coalesce(f2 = '01' and single, false) as int) as adu_count,
    case when f2 = '01' and single then coalesce(sqftmain2, 0) end as adu_sqft,
    cast(coalesce(f1 between '02' and '05', false) as int) + cast(coalesce(f2 between '02' and '05', false) as int)
      as mfr_count,
    case when f1 between '02' and '05' or f2 between '02' and '05' then
      coalesce(case when f1 between '02' and '05' then sqftmain1 end, 0)
      + coalesce(case when f2 between '02' and '05' then sqftmain2 end, 0) end as mfr_sqft
  from slots""",
    "analysis": """
  select p.seq as parcel_seq, p.ain_1 as ain, coalesce(nullif(p.apn_1, ''), p.ain_1) as apn,
    coalesce(nullif(p.situsfulladdress, ''), nullif(p.situsaddress, ''), '') as address,
    case p.damage_1 when 'Destroyed (>50%)' then 'destroyed' when 'Major (26-50%)' then 'major'
      when 'Minor (10-25%)' then 'minor' when 'Affected (1-9%)' then 'affected' when 'No Damage' then 'no_damage'
      else 'no_data' end as damage,
    case trim(p.bsd_tag) when 'Red' then 'red' when 'Yellow' then 'yellow' when 'Green' then 'green'
      else 'none' end as bsd_status,
    cast(pre.sfr_count as bigint) as pre_sfr_count, cast(pre.sfr_sqft as bigint) as pre_sfr_sqft,
    cast(pre.adu_count as bigint) as pre_adu_count, cast(pre.adu_sqft as bigint) as pre_adu_sqft,
    cast(pre.mfr_count as bigint) as pre_mfr_count, cast(pre.mfr_sqft as bigint) as pre_mfr_sqft,
    q.sfr_count as post_sfr_count, cast(q.sfr_sqft as bigint) as post_sfr_sqft,
    q.adu_count as post_adu_count, cast(q.adu_sqft as bigint) as post_adu_sqft,
    q.mfr_count as post_mfr_count, cast(q.mfr_sqft as bigint) as post_mfr_sqft,
    c.claim as lfl_claimed, coalesce(r.claim_conflict, false) as lfl_conflict,
    case when pre.sfr_sqft is null or q.sfr_sqft is null then null
      when abs(q.sfr_sqft - pre.sfr_sqft) <= 10 then 'identical'
      when q.sfr_sqft > pre.sfr_sqft then 'larger' else 'smaller' end as sfr_size_comparison,
    coalesce(r.mentions_pathway, false) as adds_sb9,
    cast(greatest(0, coalesce(q.adu_count, 0) - pre.adu_count) as bigint) as added_adu_count,
    r.max_progress as rebuild_progress_num,
    case r.max_progress when 1 then 'Rebuild Applications Received' when 2 then 'Zoning Reviews Cleared'
      when 3 then 'Full Building Plans Received' when 4 then 'Building Plans Approved'
      when 5 then 'Building Permits Issued' when 6 then 'Rebuild In Construction'
      when 7 then 'Construction Completed' end as rebuild_progress,
    nullif(trim(p.permit_status), '') as permit_status, nullif(trim(p.roe_status), '') as roe_status,
    nullif(trim(p.debris_cleared), '') as debris_cleared,
    coalesce(try_cast(p.dins_count as bigint), 0) as dins_count,
    p.cx, p.cy, coalesce(r.case_count, 0) as case_count, coalesce(r.has_qualifying, false) as has_qualifying,
    coalesce(r.has_qualifying_permit, false) as has_qualifying_permit,
    coalesce(u.all_unknown, false) as units_unknown,
    coalesce(r.parse_candidates, 0) as parse_candidates, coalesce(r.parse_hits, 0) as parse_hits,
    coalesce(r.area_candidates, 0) as area_candidates, coalesce(r.area_hits, 0) as area_hits
  from parcels p join pre on p.seq = pre.seq left join rollup r on p.ain_1 = r.main_ain
  left join primaries q on p.ain_1 = q.main_ain left join claims c on p.ain_1 = c.main_ain
  left join unit_permits u on p.ain_1 = u.main_ain""",
    # rectangles: strictly inside first, then the lowest region whose closed box holds the point
    "tract_of": """
  select seq as parcel_seq, ct20 as tract, outside from (
    select p.seq, r.ct20, not (cx > x0 and cx < x1 and cy > y0 and cy < y1) as outside,
      row_number() over (partition by p.seq
        order by not (cx > x0 and cx < x1 and cy > y0 and cy < y1), r.idx) as rn
    from parcels p join regions r on cx between x0 and x1 and cy between y0 and y1) where rn = 1""",
    "group_of": """
  select seq as parcel_seq, bg20 as block_group, outside from (
    select p.seq, r.bg20, not (cx > x0 and cx < x1 and cy > y0 and cy < y1) as outside,
      row_number() over (partition by p.seq
        order by not (cx > x0 and cx < x1 and cy > y0 and cy < y1), r.idx) as rn
    from parcels p join subregions r on cx between x0 and x1 and cy between y0 and y1) where rn = 1""",
    "assigned": """
  select a.*, t.tract, b.block_group from analysis a left join tract_of t on a.parcel_seq = t.parcel_seq
  left join group_of b on a.parcel_seq = b.parcel_seq""",
    "parcel_warnings": """
  select ain, parcel_seq, 2 as phase, 0 as code_ord, 'destroyed_no_epicla' as code, 'info' as severity,
    'parcel marked DESTROYED but has no EPIC-LA cases' as detail
  from assigned where damage = 'destroyed' and case_count = 0
  union all select ain, parcel_seq, 2, 1, 'implausible_post_sfr_sqft', 'data', 'post_sfr_sqft=' || post_sfr_sqft
  from assigned where post_sfr_sqft < 200 or post_sfr_sqft > 20000
  union all select ain, parcel_seq, 2, 2, 'permit_all_unknown_structures', 'data',
    'NEW_DWELLING_UNITS > 0 but description parsed as unknown'
  from assigned where units_unknown
  union all select ain, parcel_seq, 2, 3, 'size_compared_without_lfl_signal', 'info',
    'sfr_size_comparison=' || sfr_size_comparison || ' but no source states LFL/Custom'
  from assigned where sfr_size_comparison is not null and lfl_claimed is null
  union all select ain, parcel_seq, 2, 4, 'lfl_conflict', 'data',
    'LFL/Custom signals disagreed across PROJECT_NAME / DESCRIPTION fields; most-recent case''s signal won'
  from assigned where lfl_conflict
  union all select ain, parcel_seq, 3, 0, 'parcel_outside_census_tracts', 'data',
    'parcel centroid did not fall inside any fetched census tract'
  from assigned where tract is null""",
    # what each reply form holds
    "form_structures": """
  select * from (values
    (0, 0, 'sfr', 'a', 'high', null, 'C1'), (1, 0, 'jadu', 'b', 'medium', 'inside', ''), (1, 1, 'adu', 'b', 'high', null, ''),
    (5, 0, 'other', null, 'low', null, ''), (6, 0, 'mfr', 'a', 'medium', null, ''),
    (7, 0, 'sfr', null, 'low', null, ''), (7, 1, 'adu', '640', 'low', null, '')
  ) t(form, pos, struct_type, area, confidence, notes, evidence)""",
    "usable_replies": """
  select ain, form, a, b, case form when 0 then 'one house' when 1 then 'two units' when 4 then 'nothing filed'
    when 7 then repeat('long ', 40) else '' end as reasoning
  from replies where form in (0, 1, 4, 5, 6, 7)""",
    "reply_structures": """
  select u.ain, f.pos, f.struct_type, f.confidence, f.notes, f.evidence,
    case f.area when 'a' then cast(u.a as bigint) when 'b' then cast(u.b as bigint) when '640' then 640 end as sqft
  from usable_replies u join form_structures f on u.form = f.form""",
    "reply_posts": """
  select u.ain, any_value(u.reasoning) as reasoning,
    count(*) filter (where s.struct_type = 'sfr') as sfr_count, sum(s.sqft) filter (where s.struct_type = 'sfr') as sfr_sqft,
    count(*) filter (where s.struct_type in ('adu', 'jadu')) as adu_count,
    sum(s.sqft) filter (where s.struct_type in ('adu', 'jadu')) as adu_sqft,
    count(*) filter (where s.struct_type = 'mfr') as mfr_count, sum(s.sqft) filter (where s.struct_type = 'mfr') as mfr_sqft,
    coalesce(bool_or(s.confidence = 'low'), false) as any_low
  from usable_replies u left join reply_structures s on u.ain = s.ain group by u.ain""",
    "overlaid": """
  select a.* exclude (post_sfr_count, post_sfr_sqft, post_adu_count, post_adu_sqft, post_mfr_count, post_mfr_sqft,
      added_adu_count, sfr_size_comparison),
    a.post_sfr_count as text_sfr_count, a.post_sfr_sqft as text_sfr_sqft, a.post_adu_count as text_adu_count,
    a.post_adu_sqft as text_adu_sqft, a.post_mfr_count as text_mfr_count, a.post_mfr_sqft as text_mfr_sqft,
    m.any_low, m.reasoning, m.sfr_count, m.sfr_sqft, m.adu_count, m.adu_sqft, m.mfr_count, m.mfr_sqft,
    case when not a.has_qualifying then 'skipped' when m.ain is null then 'failed' else 'extracted' end as model_status,
    case when a.has_qualifying and m.ain is not null then m.sfr_count else a.post_sfr_count end as post_sfr_count,
    case when a.has_qualifying and m.ain is not null then m.sfr_sqft else a.post_sfr_sqft end as post_sfr_sqft,
    case when a.has_qualifying and m.ain is not null then m.adu_count else a.post_adu_count end as post_adu_count,
    case when a.has_qualifying and m.ain is not null then m.adu_sqft else a.post_adu_sqft end as post_adu_sqft,
    case when a.has_qualifying and m.ain is not null then m.mfr_count else a.post_mfr_count end as post_mfr_count,
    case when a.has_qualifying and m.ain is not null then m.mfr_sqft else a.post_mfr_sqft end as post_mfr_sqft
  from assigned a left join reply_posts m on a.ain = m.ain""",
    "issues": """
  select o.parcel_seq, o.ain, t.ord, t.code, t.severity, t.detail from overlaid o,
  lateral (
    select 0 as ord, 'llm_extraction_failed' as code, 'data' as severity,
      'LLM call failed or returned unparseable output' as detail where o.model_status = 'failed'
    union all select 1, 'extraction_only_llm', 'info',
      'no qualifying PermitManagement record; structures inferred from PlanManagement records via LLM'
      where o.model_status = 'extracted' and not o.has_qualifying_permit and greatest(o.sfr_count, o.adu_count, o.mfr_count) > 0
    union all select 2, 'extraction_count_disagreement', 'info', 'sfr: regex=' || coalesce(o.text_sfr_count, 0) || ', llm='
      || o.sfr_count || '; reasoning: ' || substr(o.reasoning, 1, 160)
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_sfr_count, 0) <> o.sfr_count
    union all select 3, 'extraction_sqft_disagreement', 'info', 'sfr: regex_sqft=' || o.text_sfr_sqft || ', llm_sqft=' || o.sfr_sqft
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_sfr_count, 0) = o.sfr_count
        and o.text_sfr_sqft > 0 and abs(o.text_sfr_sqft - o.sfr_sqft) * 10 > o.text_sfr_sqft
    union all select 4, 'extraction_count_disagreement', 'info', 'adu: regex=' || coalesce(o.text_adu_count, 0) || ', llm='
      || o.adu_count || '; reasoning: ' || substr(o.reasoning, 1, 160)
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_adu_count, 0) <> o.adu_count
    union all select 5, 'extraction_sqft_disagreement', 'info', 'adu: regex_sqft=' || o.text_adu_sqft || ', llm_sqft=' || o.adu_sqft
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_adu_count, 0) = o.adu_count
        and o.text_adu_sqft > 0 and abs(o.text_adu_sqft - o.adu_sqft) * 10 > o.text_adu_sqft
    union all select 6, 'extraction_count_disagreement', 'info', 'mfr: regex=' || coalesce(o.text_mfr_count, 0) || ', llm='
      || o.mfr_count || '; reasoning: ' || substr(o.reasoning, 1, 160)
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_mfr_count, 0) <> o.mfr_count
    union all select 7, 'extraction_sqft_disagreement', 'info', 'mfr: regex_sqft=' || o.text_mfr_sqft || ', llm_sqft=' || o.mfr_sqft
      where o.model_status = 'extracted' and o.has_qualifying_permit and coalesce(o.text_mfr_count, 0) = o.mfr_count
        and o.text_mfr_sqft > 0 and abs(o.text_mfr_sqft - o.mfr_sqft) * 10 > o.text_mfr_sqft
    union all select 8, 'extraction_low_confidence', 'info',
      'LLM marked at least one structure as low-confidence; reasoning: ' || substr(o.reasoning, 1, 160)
      where o.model_status = 'extracted' and o.any_low
  ) t""",
    "keys": f"""
  select main_ain, 'sha256:' || sha256('{{"ain": "' || main_ain || '", "model": "{MODEL}", "prompt_version": 2, "records": '
      || count(*) || ', "sums": [' || sum(l0) || ', ' || sum(l1) || ', ' || sum(l2) || ', ' || sum(l3) || ']}}') as key
  from (select main_ain, {', '.join(f"cast('0x' || substr(h, {1 + 15 * i}, 15) as bigint) as l{i}" for i in range(4))}
        from (select main_ain, sha256('["' || coalesce(casenumber, '') || '", "' || sha256(coalesce(description, '')) || '"]') as h
              from facts where is_event and is_qualifying)) group by main_ain""",
}

_NEEDS = {
    "structures": ["cases", "template_structures"],
    "parsed": ["structures"],
    "facts": ["cases", "parsed"],
    "primaries": ["facts"],
    "claims": ["facts"],
    "unit_permits": ["facts"],
    "rollup": ["facts"],
    "slots": ["parcels"],
    "pre": ["slots"],
    "analysis": ["parcels", "pre", "rollup", "primaries", "claims", "unit_permits"],
    "tract_of": ["parcels", "regions"],
    "group_of": ["parcels", "subregions"],
    "assigned": ["analysis", "tract_of", "group_of"],
    "parcel_warnings": ["assigned"],
    "usable_replies": ["replies"],
    "reply_structures": ["usable_replies", "form_structures"],
    "reply_posts": ["reply_structures"],
    "overlaid": ["assigned", "reply_posts"],
    "issues": ["overlaid"],
    "keys": ["facts"],
}


def _with(*names: str) -> str:
    """WITH clause holding the named steps and everything they read, in order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for other in _NEEDS.get(name, []):
            add(other)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({sql})" for n, sql in _CTES.items() if n in wanted) + "\n"


_RESULT = """ain, apn, address, damage, bsd_status, pre_sfr_count, pre_sfr_sqft, pre_adu_count, pre_adu_sqft,
 pre_mfr_count, pre_mfr_sqft, post_sfr_count, post_sfr_sqft, post_adu_count, post_adu_sqft, post_mfr_count,
 post_mfr_sqft, lfl_claimed, lfl_conflict, sfr_size_comparison, adds_sb9, added_adu_count, rebuild_progress_num,
 rebuild_progress, permit_status, roe_status, debris_cleared, dins_count"""

_RATIO = "cast(post_sfr_sqft as double) / pre_sfr_sqft"
_SIZED = "pre_sfr_sqft > 0 and post_sfr_sqft is not null"
_COUNTS = {
    "total_parcels": "true",
    "damaged_parcels": "damage in ('affected', 'minor', 'major', 'destroyed')",
    "destroyed_parcels": "damage = 'destroyed'",
    "bsd_red_count": "bsd_status = 'red'",
    "bsd_yellow_count": "bsd_status = 'yellow'",
    "bsd_green_count": "bsd_status = 'green'",
    "bsd_red_or_yellow_count": "bsd_status in ('red', 'yellow')",
    "no_permit_count": "rebuild_progress_num is null",
    "permit_in_review_count": "rebuild_progress_num in (1, 2, 3, 4)",
    "permit_issued_count": "rebuild_progress_num = 5",
    "construction_count": "rebuild_progress_num = 6",
    "completed_count": "rebuild_progress_num = 7",
    "lfl_count": "lfl_claimed",
    "nlfl_count": "not lfl_claimed",
    "lfl_unknown_count": "lfl_claimed is null and rebuild_progress_num is not null",
    "sfr_size_pct_smaller_over_30": f"{_SIZED} and {_RATIO} < 0.7",
    "sfr_size_pct_smaller_10_to_30": f"{_SIZED} and {_RATIO} >= 0.7 and {_RATIO} < 0.9",
    "sfr_size_pct_within_10": f"{_SIZED} and {_RATIO} >= 0.9 and {_RATIO} <= 1.1",
    "sfr_size_pct_larger_10_to_30": f"{_SIZED} and {_RATIO} > 1.1 and {_RATIO} <= 1.3",
    "sfr_size_pct_larger_over_30": f"{_SIZED} and {_RATIO} > 1.3",
    "sfr_size_pct_unknown": f"not coalesce({_SIZED}, false)",
    "sb9_count": "adds_sb9",
    "adu_added_1_count": "added_adu_count = 1",
    "adu_added_2_count": "added_adu_count = 2",
    "adu_added_3_plus_count": "added_adu_count >= 3",
    "dwelling_rebuild_count": "post_sfr_count > 0 or post_adu_count > 0",
}
_COUNT_SQL = ", ".join(f"count(*) filter (where {_COUNTS[n]}) as {n}" for n in COUNT_FIELDS)
_SUMMARY = f"summary as (select {_COUNT_SQL} from analysis)"


def _regional(layer: str, table: str, ids: str, key: str) -> str:
    counts = ", ".join(f"coalesce(c.{n}, 0) as {n}" for n in COUNT_FIELDS)
    return (
        f"select {ids}, {counts} from {table} r left join "
        f"(select {layer}, {_COUNT_SQL} from assigned where {layer} is not null group by {layer}) c "
        f"on r.{key} = c.{layer}"
    )


_TRACT_TOTALS = """tract_totals as (select r.ct20, r.idx, count(a.ain) as total
    from regions r left join assigned a on a.tract = r.ct20 group by 1, 2),
  child_totals as (select s.ct20, count(a.ain) as total
    from subregions s left join assigned a on a.block_group = s.bg20 group by 1),
  mismatches as (select t.ct20, t.idx, t.total as total_parcels, coalesce(c.total, 0) as child_sum
    from tract_totals t left join child_totals c on t.ct20 = c.ct20 where t.total <> coalesce(c.total, 0))"""

_BLOCKS = """blocks as (select *, row_number() over (partition by main_ain order by coalesce(apply_date, 0), seq) as rn,
  count(*) over (partition by main_ain) as n from facts where is_event and is_qualifying),
 bodies as (select main_ain, n, rn,
   '[' || rn || '] CASENUMBER:     ' || coalesce(casenumber, '(unknown)') || chr(10)
   || '    MODULENAME:     ' || modulename || chr(10)
   || '    WORKCLASS:      ' || workclass_name || chr(10)
   || '    PROJECT_NUMBER: ' || coalesce(project_number, '(none)') || chr(10)
   || '    PROJECT_NAME:   ' || coalesce(nullif(project_name, ''), nullif(projectname, ''), '(none)') || chr(10)
   || '    STATUS:         ' || coalesce(status, '(unknown)') || chr(10)
   || '    PROGRESS:       ' || coalesce(rebuild_progress_num || ' (' || case rebuild_progress_num
        when 1 then 'Plans Submitted' when 2 then 'Plans Under Review' when 3 then 'Plans Approved'
        when 4 then 'Permit Issued' when 5 then 'Construction Started' when 6 then 'Issued'
        when 7 then 'Finaled' end || ')', '(unknown)') || chr(10)
   || '    APPLY_DATE:     ' || coalesce(cast(date '1970-01-01' + cast(apply_date / 86400000 as integer) as varchar)[:10],
        '(unknown)') || chr(10)
   || '    DESCRIPTION:' || chr(10)
   || '      ' || replace(replace(coalesce(description, '(blank)'), chr(13) || chr(10), chr(10)),
        chr(10), chr(10) || '      ') || chr(10) as body
  from blocks)"""

_PRE_TEXT = """coalesce(nullif(concat_ws(', ',
   case when p.pre_sfr_count > 0 then p.pre_sfr_count || ' SFR (' || coalesce(cast(nullif(p.pre_sfr_sqft, 0) as varchar), '?') || ' SF total)' end,
   case when p.pre_adu_count > 0 then p.pre_adu_count || ' ADU (' || coalesce(cast(nullif(p.pre_adu_sqft, 0) as varchar), '?') || ' SF total)' end,
   case when p.pre_mfr_count > 0 then p.pre_mfr_count || ' MFR (' || coalesce(cast(nullif(p.pre_mfr_sqft, 0) as varchar), '?') || ' SF total)' end
  ), ''), '(none recorded)')"""


def _csv_fields() -> str:
    names = [n.strip() for n in _RESULT.split(",")]
    return ", ".join(f"coalesce(cast({n} as varchar), '') as {n}" for n in names)


_ENVELOPE = "(select min(cx - 0.004) as xmin, min(cy - 0.004) as ymin, max(cx + 0.004) as xmax, max(cy + 0.004) as ymax from parcels)"

def _texts(names: str) -> str:
    """Columns as the JSON text of a property."""
    return ", ".join(f"cast({n.strip()} as varchar) as {n.strip()}" for n in names.split(","))


def _square(x0: str, y0: str, x1: str, y1: str) -> str:
    """The ordinates of a rectangle's closed ring."""
    corners = ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    return ", ".join(f"cast({x} as double) as x{i}, cast({y} as double) as y{i}" for i, (x, y) in enumerate(corners))


_WEDGE_CHOICES = """choices as (
  select p.seq as parcel_seq, r.ct20, r.idx,
    not (cx > x0 and cy > y0 and (cx - x0) + (cy - y0) < 2) as outside,
    least(
      sqrt(pow(cx - (x0 + least(2, greatest(0, cx - x0))), 2) + pow(cy - y0, 2)),
      sqrt(pow(cx - x0, 2) + pow(cy - (y0 + least(2, greatest(0, cy - y0))), 2)),
      sqrt(pow(cx - (x1 - 2 * least(1, greatest(0, ((x1 - cx) + (cy - y0)) / 4))), 2)
         + pow(cy - (y0 + 2 * least(1, greatest(0, ((x1 - cx) + (cy - y0)) / 4))), 2))) as d
  from parcels p join regions r on cx between x0 and x1 and cy between y0 and y1),
 picked as (select *, row_number() over (partition by parcel_seq
   order by outside, case when outside then round(d, 9) else 0 end, idx) as rn from choices)"""


def statements() -> dict[str, str]:
    facts = _with("facts")
    out = {
        "join_cases_left": _with("parcels", "cases")
        + """select p.seq as parcel_seq, p.ain_1 as ain, count(c.seq) as case_count
from parcels p left join cases c on p.ain_1 = c.main_ain group by 1, 2""",
        "orphan_keys": _with("parcels", "cases")
        + """select c.main_ain, count(*) as case_count from cases c
where not exists (select 1 from parcels p where p.ain_1 = c.main_ain) group by 1""",
        "match_counts": _with("parcels", "cases")
        + """select count(*) as parcels, count(*) filter (where n > 0) as parcels_with_case,
 count(*) filter (where n = 0) as parcels_without_case,
 (select count(distinct main_ain) from cases where main_ain not in (select ain_1 from parcels)) as orphan_keys,
 (select count(*) from cases where main_ain not in (select ain_1 from parcels)) as orphan_cases
from (select p.seq, count(c.seq) as n from parcels p left join cases c on p.ain_1 = c.main_ain group by 1)""",
        "case_flags": facts
        + """select seq, is_event, is_permit, is_primary, is_qualifying, desc_signal, name_signal,
 mentions_pathway from facts""",
        "case_dates": _with("cases")
        + """select seq, coalesce(cast(cast(date '1970-01-01' + cast(apply_date / 86400000 as integer) as date) as varchar),
 '(unknown)') as apply_day from cases""",
        "max_progress": facts
        + "select main_ain, max(rebuild_progress_num) filter (where is_event) as max_progress from facts group by 1",
        "primary_pick": _with("primaries") + "select main_ain, seq as primary_seq from primaries",
        "latest_claim": _with("claims") + "select main_ain, claim from claims",
        "claim_conflict": _with("rollup") + "select main_ain, claim_conflict from rollup",
        "pathway_mentions": _with("rollup") + "select main_ain, mentions_pathway from rollup",
        "qualifying_keys": _with("rollup") + "select main_ain, has_qualifying, has_qualifying_permit from rollup",
        "first_unit_permit": _with("unit_permits")
        + "select main_ain, all_unknown as units_unknown from unit_permits",
        "case_structures": _with("structures")
        + "select seq, main_ain, seg_idx, struct_type, sqft, raw_segment from structures",
        "structure_totals": _with("structures")
        + """select struct_type, count(*) as structures, count(sqft) as with_area, sum(sqft) as area
from structures group by 1""",
        "parcel_post_state": _with("primaries")
        + """select main_ain, sfr_count, cast(sfr_sqft as bigint) as sfr_sqft, adu_count,
 cast(adu_sqft as bigint) as adu_sqft, mfr_count, cast(mfr_sqft as bigint) as mfr_sqft from primaries""",
        "pre_state": _with("analysis")
        + f"""select parcel_seq, pre_sfr_count, pre_sfr_sqft, pre_adu_count, pre_adu_sqft, pre_mfr_count,
 pre_mfr_sqft, {_PRE_TEXT} as pre_text from analysis p""",
        "parcel_result": _with("analysis") + f"select {_RESULT} from analysis",
        "parcel_csv_rows": _with("analysis") + f"select {_csv_fields()} from analysis",
        "summary_counts": _with("analysis") + f"select {_COUNT_SQL} from analysis",
        "summary_from_cells": _with("analysis") + f"select {_COUNT_SQL} from analysis",
        "region_assignment": _with("assigned") + "select parcel_seq, tract, block_group from assigned",
        "region_counts": _with("assigned") + _regional("tract", "regions", "r.ct20, r.label", "ct20"),
        "subregion_counts": _with("assigned")
        + _regional("block_group", "subregions", "r.bg20, r.ct20, r.label", "bg20"),
        "unassigned": _with("assigned") + "select parcel_seq, ain from assigned where tract is null",
        "nearest_region": _with("parcels", "regions").rstrip()
        + f", {_WEDGE_CHOICES}\n"
        + """select parcel_seq, ct20 as wedge, outside as by_distance,
 case when outside then round(d, 6) else 0.0 end as distance from picked where rn = 1""",
        "parcel_features": _with("analysis")
        + f"""select 'Feature' as kind, 'Polygon' as shape, {_texts(_RESULT)}, {_square('cx - 0.004', 'cy - 0.004', 'cx + 0.004', 'cy + 0.004')} from analysis""",
        "region_features": _with("assigned").rstrip()
        + f""", counted as ({_regional("tract", "regions", "r.ct20, r.label, r.x0, r.y0, r.x1, r.y1", "ct20")})
select 'Feature' as kind, 'Polygon' as shape, ct20, label, {_texts(', '.join(COUNT_FIELDS))}, {_square('x0', 'y0', 'x1', 'y1')} from counted""",
        "geometry_kinds": """select c_custkey as seq, case c_custkey % 6 when 3 then 'Point' when 4 then 'LineString' when 5 then null else 'MultiPolygon' end as kind,
 case when c_custkey % 6 <> 5 then 2 end as members from customer""",
        "largest_ring_centroids": """select c_custkey as seq, c_custkey + d as px, cast(d as double) as py
from (select c_custkey, case c_custkey % 6 when 0 then 2.0 when 1 then 6.0 when 2 then 1.5 end as d from customer) where d is not null""",
        "summary_json": _with("analysis") + f"select '{STAMP}' as generated_at, {_COUNT_SQL} from analysis",
        "warnings_disabled": _with("parcel_warnings")
        + """select ain, code, detail, severity from parcel_warnings union all select '*', 'llm_disabled', 'switched off', 'info'""",
        "cache_next": _with("keys", "replies", "parcels", "reply_structures")
        + """select k.key, k.main_ain as ain, case when r.form in (0, 1) then 'old' else 'new' end as extracted_at,
 case when r.form in (0, 1) then '' else coalesce((select string_agg(s.struct_type || '|' || coalesce(cast(s.sqft as varchar), '-') || '|'
   || s.confidence || '|' || case s.evidence when '' then '0' else '1' end || '|' || coalesce(s.notes, '-'), ';' order by s.pos)
   from reply_structures s where s.ain = r.ain), '') end as structures,
 case when r.form in (0, 1) then '' else u.reasoning end as reasoning
from keys k join replies r on k.main_ain = r.ain join usable_replies u on u.ain = r.ain""",
        "cache_pruned": _with("keys", "parcels")
        + "select count(*) as pruned from keys where main_ain not in (select ain_1 from parcels)",
        "contract_problems": """select 'cases' as source, c_custkey as seq, 'MODULENAME' as field, 'mistyped' as problem from customer where c_custkey % 7 = 0
union all select 'cases', c_custkey, 'REBUILD_PROGRESS_NUM', 'mistyped' from customer where c_custkey % 5 = 0
union all select 'cases', c_custkey, 'DESCRIPTION', 'mistyped' from customer where c_custkey % 11 = 0
union all select 'tracts', c_custkey, 'CT20', 'empty' from customer where c_custkey % 13 = 0
union all select 'block_groups', c_custkey, 'BG20', 'missing' from customer where c_custkey % 3 = 0""",
        "source_filters": _with("cases")
        + """select 'area' as source, c_custkey as id from customer where c_mktsegment = 'BUILDING'
union all select 'cases', seq from cases where disaster_type = 'Eaton Fire (01-2025)'""",
        "warnings": _with("parcel_warnings") + "select ain, code, detail, severity from parcel_warnings",
        "warning_rollup": _with("parcel_warnings")
        + "select code, count(*) as warning_count from parcel_warnings group by 1",
        "warning_table": _with("parcel_warnings")
        + "select ain, code, detail, severity from parcel_warnings where severity = 'data'",
        "flagged_rate": _with("parcel_warnings")
        + """select count(distinct w.ain) as flagged, (select count(*) from assigned) as total
from parcel_warnings w where w.severity = 'data'""",
        "partition_totals": _with("assigned", "regions", "subregions").rstrip()
        + f""", {_TRACT_TOTALS}\nselect t.ct20, t.total as total_parcels, coalesce(c.total, 0) as child_sum
from tract_totals t left join child_totals c on t.ct20 = c.ct20""",
        "quality_checks": _with("parcel_warnings", "regions", "subregions").rstrip()
        + f""", {_TRACT_TOTALS},
 t as (select count(*) as total, count(*) filter (where rebuild_progress_num = 7) as done,
   count(*) filter (where tract is null) as lost,
   sum(parse_candidates) as pc, sum(parse_hits) as ph, sum(area_candidates) as ac, sum(area_hits) as ah from assigned),
 w as (select count(distinct ain) as flagged from parcel_warnings where severity = 'data'),
 s as (select sum(total) as placed from tract_totals),
 m as (select count(*) as bad, (select string_agg('ct20=' || ct20 || ' tract=' || total_parcels || ' bg_sum=' || child_sum, '; '
     order by idx) from (select * from mismatches order by idx limit 3)) as named from mismatches)
select 'description_parse_rate' as name, ph / pc as actual, 0.9 as threshold, ph / pc >= 0.9 as passed,
  cast(ph as bigint) || '/' || cast(pc as bigint) || ' fire permits parsed to a structure' as detail from t
union all select 'sfr_sqft_extraction_rate', ah / ac, 0.85, ah / ac >= 0.85, cast(ah as bigint) || '/' || cast(ac as bigint)
  || ' permits whose DESCRIPTION mentions SFR/SFD/SINGLE-FAMILY + sqft were parsed as sfr+sqft' from t
union all select 'warning_rate', flagged / total, 0.05, flagged / total <= 0.05, flagged || '/' || total
  || ' parcels raised at least one data-severity warning (info-severity warnings excluded)' from t, w
union all select 'min_completed_rebuilds', cast(done as double), 1.0, done >= 1,
  done || ' parcels reported Construction Completed' from t
union all select 'tract_total_matches_summary', cast(total - (placed + lost) as double), 0.0, total = placed + lost,
  'sum(tract.total_parcels)=' || cast(placed as bigint) || ' + unassigned=' || lost || ' vs. burn-area total=' || total
  || ' (diff=' || cast(total - (placed + lost) as bigint) || ')' from t, s
union all select 'tract_partitions_into_block_groups', cast(bad as double), 0.0, bad = 0,
  bad || ' tract(s) disagree with their block-groups' || coalesce(': ' || named, '') from m""",
        "content_keys": _with("keys") + "select main_ain, key from keys",
        "extraction_inputs": _with("keys")
        + """select k.key, f.seq, coalesce(f.casenumber, '') as case_number from facts f join keys k on f.main_ain = k.main_ain
where f.is_event and f.is_qualifying""",
        "user_prompts": _with("analysis").rstrip()
        + f""", {_BLOCKS}
select p.parcel_seq, p.ain, 0 as part, 'PARCEL CONTEXT' || chr(10) || 'AIN: ' || p.ain || chr(10)
 || 'Address: ' || coalesce(nullif(p.address, ''), '(unknown)') || chr(10) || 'DAMAGE: ' || p.damage || chr(10)
 || 'Pre-fire structures (from DINS): ' || {_PRE_TEXT} || chr(10) || chr(10)
 || 'RECORDS (' || b.n || ' qualifying, sorted by APPLY_DATE):' || chr(10) as user_prompt
from analysis p join bodies b on p.ain = b.main_ain where b.rn = 1
union all select p.parcel_seq, p.ain, b.rn, b.body from analysis p join bodies b on p.ain = b.main_ain""",
        "cache_misses": _with("keys", "replies")
        + """select k.main_ain, k.key from keys k left join replies r on k.main_ain = r.ain
where r.form is null or r.form not in (0, 1)""",
        "cache_prune": _with("keys", "parcels")
        + "select k.main_ain as ain, k.key from keys k join parcels p on k.main_ain = p.ain_1",
        "cache_entries": """select 'k' || c_custkey - cast(c_custkey % 10 = 9 as int) as key, cast(c_custkey as varchar) as ain,
 '' as extracted_at, '' as model, 2 as prompt_version, '' as reasoning, 7 as input_tokens, 0 as output_tokens,
 case when c_custkey % 10 = 6 then '' else 'sfr|' || case c_custkey % 10 when 2 then '640' when 3 then '-'
   else cast(c_custkey as varchar) end || '|low|0|-' end as structures
from customer c where c_custkey % 10 not in (1, 4, 5)
 and not (c_custkey % 10 = 8 and exists (select 1 from customer d where d.c_custkey = c.c_custkey + 1))""",
        "reply_status": _with("replies", "usable_replies")
        + """select r.ain, u.ain is not null as ok, u.reasoning from replies r left join usable_replies u on r.ain = u.ain""",
        "reply_structures": _with("reply_structures")
        + "select ain, pos, struct_type, sqft, confidence, notes, evidence from reply_structures",
        "extraction_issues": _with("issues") + "select parcel_seq, ain, code, severity, detail from issues",
        "extraction_override": _with("overlaid")
        + """select parcel_seq, model_status, post_sfr_count, cast(post_sfr_sqft as bigint) as post_sfr_sqft, post_adu_count,
 cast(post_adu_sqft as bigint) as post_adu_sqft, post_mfr_count, cast(post_mfr_sqft as bigint) as post_mfr_sqft,
 cast(greatest(0, coalesce(post_adu_count, 0) - pre_adu_count) as bigint) as added_adu_count,
 case when pre_sfr_sqft is null or post_sfr_sqft is null then null
  when abs(post_sfr_sqft - pre_sfr_sqft) <= 10 then 'identical'
  when post_sfr_sqft > pre_sfr_sqft then 'larger' else 'smaller' end as sfr_size_comparison
from overlaid""",
        "extraction_metrics": _with("issues", "keys", "replies")
        + f"""select true as enabled, '{MODEL}' as model, 2 as prompt_version, attempted as parcels_attempted,
 extracted as parcels_extracted, failed as parcels_failed, plan_only as plan_only_parcels,
 extracted - misses as cache_hits, misses as cache_misses,
 round_even(1 - (cd + sd) / extracted, 4) as agreement_rate, cd as count_disagreements, sd as sqft_disagreements,
 lc as low_confidence_parcels, ef as extraction_failures
from (select count(*) filter (where model_status <> 'skipped') as attempted,
   count(*) filter (where model_status = 'extracted') as extracted,
   count(*) filter (where model_status = 'failed') as failed,
   count(*) filter (where model_status <> 'skipped' and not has_qualifying_permit) as plan_only from overlaid),
  (select count(*) as misses from keys k join replies r on k.main_ain = r.ain where r.form in (4, 5, 6, 7)),
  (select count(distinct ain) filter (where code = 'extraction_count_disagreement') as cd,
   count(distinct ain) filter (where code = 'extraction_sqft_disagreement') as sd,
   count(distinct ain) filter (where code = 'extraction_low_confidence') as lc,
   count(distinct ain) filter (where code = 'llm_extraction_failed') as ef from issues)""",
        "bucket_shares": _with("analysis").rstrip()
        + f""", {_SUMMARY}, b as (
 select 'size' as chart, 0 as position, '>30% smaller' as label, sfr_size_pct_smaller_over_30 as value, dwelling_rebuild_count as d from summary
 union all select 'size', 1, '10–30% smaller', sfr_size_pct_smaller_10_to_30, dwelling_rebuild_count from summary
 union all select 'size', 2, '±10%', sfr_size_pct_within_10, dwelling_rebuild_count from summary
 union all select 'size', 3, '10–30% larger', sfr_size_pct_larger_10_to_30, dwelling_rebuild_count from summary
 union all select 'size', 4, '>30% larger', sfr_size_pct_larger_over_30, dwelling_rebuild_count from summary
 union all select 'added_units', 0, '+1 ADU', adu_added_1_count, dwelling_rebuild_count from summary
 union all select 'added_units', 1, '+2 ADUs', adu_added_2_count, dwelling_rebuild_count from summary
 union all select 'added_units', 2, '+3 or more', adu_added_3_plus_count, dwelling_rebuild_count from summary
   where adu_added_3_plus_count > 0)
select chart, position, label, value, round(value / nullif(d, 0) * 100, 1) as share_pct from b""",
        "claim_shares": _with("analysis").rstrip()
        + f""", {_SUMMARY}, b as (
 select 0 as position, 'Like-for-like' as label, lfl_count as value from summary
 union all select 1, 'Not like-for-like', nlfl_count from summary
 union all select 2, 'Not specified', lfl_unknown_count from summary)
select position, label, value, coalesce(round(value / nullif(sum(value) over (), 0) * 100, 0), 0) as share_pct from b""",
        "envelope": _with("parcels") + f"select * from {_ENVELOPE}",
        "regions_in_envelope": _with("parcels", "regions")
        + f"""select r.ct20, r.label from regions r, {_ENVELOPE} e
where 2 * r.x1 >= e.xmin and 2 * r.x0 <= e.xmax and 2 * r.y1 >= e.ymin and 2 * r.y0 <= e.ymax""",
        "subregions_of": _with("parcels", "regions", "subregions")
        + f"""select s.bg20, s.ct20 from subregions s where s.ct20 in (select r.ct20 from regions r, {_ENVELOPE} e
where 2 * r.x1 >= e.xmin and 2 * r.x0 <= e.xmax and 2 * r.y1 >= e.ymin and 2 * r.y0 <= e.ymax)""",
        "page_flatten": """select (place - 1) * 4294967296 + pos - 1 as seq, name, segment, x from (
 select c_custkey, c_name as name, c_mktsegment as segment, c_acctbal as x,
  dense_rank() over (order by c_custkey // 1000) as place,
  row_number() over (partition by c_custkey // 1000 order by c_custkey) as pos from customer) where c_custkey % 37 <> 0""",
        "snapshot_rows": """select 's}{"' as source, 't' || cast(c_custkey // 1000 as varchar) as fetched_at,
 (dense_rank() over (order by c_custkey // 1000) - 1) * 4294967296
  + row_number() over (partition by c_custkey // 1000 order by c_custkey) - 1 as seq, c_custkey as id,
 c_name || case c_custkey % 3 when 0 then '}, {"records": [' when 1 then '\\" ]} \\\\' else '[{' || chr(10) || chr(9) end as name,
 -c_custkey as part from customer""",
        "latest_version": """select o_custkey as "table", strftime(o_orderdate, '%Y-%m-%d') as snapshot_date, o_orderkey as version,
 'a' || cast(o_orderkey as varchar) as attempt from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
        "record_problems": """select c_custkey as seq, 'AIN_1' as field,
  case c_custkey % 41 when 0 then 'missing' when 1 then 'mistyped' when 2 then 'empty' end as problem
from customer where c_custkey % 41 in (0, 1, 2)
union all select c_custkey, 'DAMAGE_1', 'missing' from customer where c_custkey % 43 = 0
union all select c_custkey, 'SQFTmain1', 'mistyped' from customer where c_custkey % 47 = 0
union all select c_custkey, 'COMMUNITY', 'mistyped' from customer where c_custkey % 53 = 0""",
        "freshness": """select event_id, epoch(timestamp '2024-01-15 00:00:00') - epoch(ts) > 96 * 3600 as is_stale from events""",
        "document_flags": """select doc_id,
 case when regexp_matches(text, '(?i)non[\\s-]*like[\\s-]*for[\\s-]*like') then false
  when regexp_matches(text, '(?i)like[\\s-]*for[\\s-]*like') then true end as claim,
 regexp_matches(text, '(?i)\\bSB[\\- ]?9\\b|\\bSENATE\\s+BILL\\s*9') as mentions_pathway from documents""",
        "document_segments": """with lines as (
 select doc_id, i, string_split_regex(text, '\\r\\n|\\n')[i] as line
 from (select doc_id, text, unnest(range(1, len(string_split_regex(text, '\\r\\n|\\n')) + 1)) as i from documents)),
 marked as (select *, regexp_matches(line, '^\\s*\\d+\\.\\s') as is_item from lines),
 numbered as (select *, sum(cast(is_item as int)) over (partition by doc_id order by i) as item from marked),
 segs as (select doc_id, item, regexp_replace(string_agg(
   case when is_item then regexp_replace(line, '^\\s*\\d+\\.\\s', '') else line end, chr(10) order by i),
   '^\\s+|\\s+$', '', 'g') as seg from numbered group by 1, 2)
select doc_id, row_number() over (partition by doc_id order by item nulls first) - 1 as position, seg as segment
from segs where seg <> ''""",
    }
    checks = out["quality_checks"]
    at = checks.index("\nselect 'description_parse_rate'")
    gates = f"{checks[:at]}, gates as ({checks[at:]})\n"
    out["failed_checks"] = gates + "select name from gates where not passed"
    out["report_head"] = gates + (
        f"select '{STAMP}' as generated_at, (select count(*) from assigned) as total_parcels, bool_and(passed) as passed from gates"
    )
    return out
